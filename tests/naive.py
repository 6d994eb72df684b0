"""The reference-shaped plan (kernel ⟕ seven measures): the differential check of the one-pass mart."""

from pyspark.sql import functions as F

from ledgerloom.functions.money import NATURAL_PERSON
from ledgerloom.operators import MEASURES, PAYMENTS_COLUMNS, get_dialect, ledger_kernel
from ledgerloom.operators import measures as M


def naive_payments_mart(tables, dialect="frame"):
    d = get_dialect(dialect)
    out = ledger_kernel(tables.operations, tables.accounts, keep_orphans=d.keep_orphans)
    for name in M.MEASURE:
        out = out.join(M.measure(name, tables, d), ["AccountId", "CutoffDt"], "left")
    return out.fillna(0, subset=MEASURES).select(*PAYMENTS_COLUMNS)


def enrollment_v1(tables):
    return M._round_sum_by(M.v1_ops(tables), "AccountCR", "EnrollmentAmt")


def natural_person_v1(tables):
    acc = tables.accounts.select(F.col("AccountId").alias("AccountCR"), F.col("ClientId").alias("cp_client"))
    cl = tables.clients.select(F.col("ClientId").alias("cp_client"), "Type")
    j = M.v1_ops(tables).join(acc, "AccountCR").join(cl, "cp_client").filter(F.col("Type") == NATURAL_PERSON)
    return M._round_sum_by(j, "AccountDB", "FLAmt")


def naive_payments_mart_v1(tables):
    out = ledger_kernel(tables.operations, tables.accounts, keep_orphans=False)
    for m in (M.payment_v1(tables), enrollment_v1(tables), M.tax_v1(tables), M.clear_v1(tables),
              M.cars_v1(tables), M.food_v1(tables), natural_person_v1(tables)):
        out = out.join(m, ["AccountId", "CutoffDt"], "left")
    return out.select(*PAYMENTS_COLUMNS)
