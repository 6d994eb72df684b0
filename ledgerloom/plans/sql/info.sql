-- Client mart: totals per client and cutoff date (clients without activity absent).
SELECT c.ClientId, c.ClientName, c.Type, c.Form, c.RegisterDate,
       CAST(t.TotalAmt AS decimal(38,2)) AS TotalAmt, t.CutoffDt
FROM (SELECT ClientId, CutoffDt, sum(TotalAmt) AS TotalAmt
      FROM {corporate_account} GROUP BY ClientId, CutoffDt) t
JOIN {clients} c ON c.ClientId = t.ClientId
