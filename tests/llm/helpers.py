"""Small inputs shared by the tests of the corpus operators."""

from pathlib import Path

import pyarrow.dataset as ds

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ["key", "digest", "_digest", "_winner", "_wdigest", "fp", "words", "copies", "keep", "_gone_key", "n",
           "_mix_key", "_mix_copies", "_toxic_score", "_row_key", "node", "root", "id", "term", "rate", "p"]


def rows(name: str, sf: str = SF) -> list[dict]:
    return ds.dataset(Path(sf) / f"{name}.parquet").to_table().to_pylist()


def documents(spark, pairs, clashes=False):
    """A documents table of ``(doc_id, text)`` pairs; optionally with clashing extra columns."""
    data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
    if not clashes:
        return spark.createDataFrame(data, SCHEMA)
    wide = SCHEMA + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("x" for _ in CLASHES)) for r in data], wide)


LONG = " ".join(f"w{i % 977}" for i in range(60_000))
#: Null id, null text, empty and blank text, ties, repeated rows, a very long text.
ODD = [(None, "Null id text"), (None, "Null id text"), (7, None), (8, ""), (9, " \t\n"), (5, "same words here"),
       (6, "SAME words here"), (4, "same words here"), (4, "same words here"), (3, LONG), (2, LONG + " end"),
       (1, "é ß Ünï 漢字 \U0001f600 <|endoftext|> it's")]
