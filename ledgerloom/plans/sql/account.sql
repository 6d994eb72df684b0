-- Account mart, SQL dialect: inner joins; each side narrowed to decimal(10,2)
-- first, NULL when it does not fit.
SELECT p.AccountId, a.AccountNum, a.DateOpen, p.ClientId, c.ClientName,
       CAST(try_cast(coalesce(p.PaymentAmt, 0) AS decimal(10,2))
          + try_cast(coalesce(p.EnrollmentAmt, 0) AS decimal(10,2)) AS decimal(38,2)) AS TotalAmt,
       p.CutoffDt
FROM {corporate_payments} p
JOIN {accounts} a ON p.AccountId = a.AccountId
JOIN {clients} c ON p.ClientId = c.ClientId
