"""SQL mart chain in one session (CM10, SRC4, SRC7).

The three SQL-dialect marts as SQL text kept in ``plans/sql/``, run with
``spark.sql`` over named frames. The keyword dictionary is applied once by
the matcher and passed as ``operations_tagged``, so the SQL
needs no theta join against the dictionary. With ``out_dir`` every mart is
written and the next one reads the written table (no re-evaluation).
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyword_join import tag
from ..schemas import LedgerTables
from ..sinks.writers import write_partitioned


#: Keys by which operations are dealt out once for the payments text's groupings.
DEAL_KEYS = ("AccountDB", "AccountCR", "DateOp")
#: Buckets of the keys' hash whose rows are counted, and how many times its share one may have.
BUCKETS, SHARE = 4096, 4


def sql_text(name: str) -> str:
    """Text of one of the packaged SQL files (UTF-8)."""
    return resources.files("ledgerloom.plans.sql").joinpath(f"{name}.sql").read_text(encoding="utf-8")


def tag_operations(tables: LedgerTables, mode: str = "token", trim: bool = False) -> DataFrame:
    """Operations plus ``kw_cars`` / ``kw_food`` flags (dictionary hits)."""
    tagged = tag(tables.operations, tables.keywords, {"List_1": mode, "List_2": mode},
                 trim_comment=trim, trim_words=trim)
    return tagged.withColumnsRenamed({"hit_List_1": "kw_cars", "hit_List_2": "kw_food"})


def _even(df: DataFrame, keys: tuple[str, ...]) -> bool:
    """Whether no bucket of the keys' hash, and so no key, has more than SHARE times its share of the rows."""
    counts = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = counts.agg(F.sum("n"), F.max("n")).first()
    return rows is not None and most * BUCKETS <= rows * SHARE


def _together(tagged: DataFrame, operations: DataFrame) -> DataFrame:
    """Tagged operations dealt out once, so that the payments text's first two groupings need no shuffle of their own.

    Only where the keys are spread evenly: a hot pair of accounts is left to the groupings, which sum before they shuffle.
    """
    return tagged.repartition(*DEAL_KEYS) if _even(operations, DEAL_KEYS) else tagged


def run_sql_marts(spark: SparkSession, tables: LedgerTables,
                  out_dir: str | None = None) -> dict[str, DataFrame]:
    """payments, account, info. The inputs are passed by name to ``spark.sql``,
    so no view of the caller's session is created or replaced."""
    frames = {"operations_tagged": _together(tag_operations(tables), tables.operations), "rates": tables.rates,
              "accounts": tables.accounts, "clients": tables.clients}
    out: dict[str, DataFrame] = {}
    for name in ("payments", "account", "info"):
        text = sql_text(name)
        df = spark.sql(text, **{k: v for k, v in frames.items() if "{" + k + "}" in text})
        if out_dir is not None:
            path = f"{out_dir.rstrip('/')}/corporate_{name}"
            write_partitioned(df, path, "CutoffDt")
            df = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        out[name] = frames[f"corporate_{name}"] = df
    return out


def correlated_payments(spark: SparkSession, tables: LedgerTables) -> DataFrame:
    """The payments mart as one correlated scalar subquery per measure and kernel row (JN12).

    Spark decorrelates each into an aggregate and an outer join on (account, date). Operations are
    summed by (debit, credit, date) before they meet a counterparty, so a hot one is small there.
    """
    return spark.sql(sql_text("payments_correlated"), operations_tagged=tag_operations(tables), rates=tables.rates,
                     accounts=tables.accounts, clients=tables.clients)
