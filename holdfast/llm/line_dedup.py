"""Cross-site boilerplate: lines that spread over many sites are removed from all documents but the first.

One HyperLogLog sketch of the sites is kept per line hash; sketches merge in the aggregation, before and after the
shuffle, so a line that every document holds is a few rows. Only lines whose estimate lies near the threshold are
counted exactly. Line hashes have 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import release, slices
from holdfast.session import materialize

#: White space that is cut from the ends of a line before lines are compared.
BLANKS = " \t\r\x0b\x0c"
LOG_K = 12
ERROR = 1.04 / 2 ** (LOG_K / 2)
_LAST = (1 << 63) - 1


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(doc, mark, site, pos, h1, h2) of every line that is not blank. A null id counts as the largest."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("mark"),
        F.col(site_col).cast("string").alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter("line <> ''")
    return rows.select("doc", "mark", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def widespread(lines: DataFrame, sites: int) -> DataFrame:
    """(h1, h2, first) of the lines found on at least ``sites`` sites; first is the smallest document that has it."""
    band = max(1.0, 3 * ERROR * sites)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"), F.min("doc").alias("first"))
    spread = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("estimate")).filter(F.col("estimate") > sites - band - 1)
    spread = materialize(spread, "spread")
    near = spread.filter(F.abs(F.col("estimate") - sites) <= band)
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact"))
    sure = spread.filter(F.col("estimate") > sites + band).select("h1", "h2", "first")
    settled = near.join(exact.filter(F.col("exact") >= sites), ["h1", "h2"]).select("h1", "h2", "first")
    return materialize(sure.unionByName(settled), "boilerplate")


def _without(text: str | None, positions: list[int] | None) -> str | None:
    if text is None or positions is None:
        return text
    drop = set(positions)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in drop)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, text, gone) with the lines at the places ``gone`` taken out of the text."""
    for batch in slices(batches):
        kept = [_without(t, p) for t, p in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string()), batch.column("gone")], ["row", "text", "gone"])
    release()


def remove_boilerplate(
    docs: DataFrame, sites: int = 8, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with all its rows and columns, and without the lines that at least ``sites`` distinct sites share.

    Lines are compared without white space at their ends; blank lines stay. A shared line stays, everywhere in it, in
    the document with the smallest id that has it. A null site is no site, a null text stays null, a null id comes
    after all others. Repeated rows are treated alike, and an empty table gives no rows. ``counts`` names two more columns: lines, and lines removed.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    shared = widespread(lines, sites)
    hits = lines.join(shared, ["h1", "h2"]).filter("doc > first")
    gone = hits.groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone"))

    def key(c: Column) -> Column:
        return F.coalesce(c.cast("long"), F.lit(_LAST))

    text = docs[f"`{text_col}`"].cast("string")
    tagged = docs.select(F.struct("*").alias("row"), text.alias("text"), key(docs[f"`{id_col}`"]).alias("doc"), F.xxhash64(text).alias("mark"))
    found = tagged.join(gone, ["doc", "mark"], "left").select("row", "text", "gone")
    cut = found.mapInArrow(_cut, found.schema)
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    if counts:
        before = F.col("row")[text_col]
        n = F.when(before.isNull(), 0).otherwise(F.size(F.split(before, "\n", -1))).cast("long")
        columns += [n.alias(counts[0]), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(counts[1])]
    return cut.select(*columns)
