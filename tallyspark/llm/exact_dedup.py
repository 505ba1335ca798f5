r"""Exact deduplication: group by a 128-bit content hash, keep the smallest
stable id, compare bytes inside the groups.

Texts are equal when identical after deleting every character of
``[\x20\x09-\x0D]``; a null text counts as empty. Of equal texts the row with
the most code points in the original text stays, then the smallest id.

Shape at scale: one scan turns each row into about 70 bytes (id, 128-bit hash,
length, SHA-256). Groups are counted in two map-side combined aggregates, so a
group with a third of all rows arrives as a few partial sums. The text itself
travels only for the byte comparison: rows of groups with two or more members
are grouped by (hash, text), again combined map-side, which leaves one text per
distinct content and task. A hash with two contents is split by content.

Cases: a null id never wins against another id of the same length; where the
longest rows have null ids only, ``keep_id`` is null. Repeated rows (same id, equal text) are copies of one
document: each is marked kept when its id is the one that stays, and
``drop_copies`` keeps one of them. An empty table gives an empty result. Extra
columns are ignored here and carried through by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import WHITE_SPACE, table
from tallyspark.operators.joins import sized_broadcast
from tallyspark.session import stage, unstage

SMALL_GROUPS = 200_000  # groups that are broadcast (about 100 bytes each)


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def md5_128(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   hash128: Callable[[Column], Column] = md5_128) -> tuple[DataFrame, DataFrame]:
    """``(rows, groups)``: one row per document ``(id, h, len, sha)`` and one
    row per content held by two or more rows ``(h, sha, keep_id, keep_len,
    n)``, both stored tables. A content is identified by ``(h, sha)`` only
    after the byte comparison has shown that this pair separates the texts."""
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    norm = text.select("id", F.length("text").alias("len"), normalised(F.col("text")).alias("norm"))
    keyed = norm.select("id", "len", "norm", hash128(F.col("norm")).alias("h"))
    rows = stage(keyed.select("id", "len", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-rows")
    many = stage(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "dedup-many")

    # bytes compared inside the groups: one row per (hash, text)
    texts = (keyed.join(many, "h", "left_semi").groupBy("h", "norm").agg(F.lit(1).alias("one"))
             .select("h", F.unhex(F.sha2("norm", 256)).alias("sha")))
    clash = (texts.groupBy("h", "sha").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1").limit(1).collect())
    if clash:
        raise ValueError("two different texts share both the 128-bit hash and SHA-256")

    # h alone groups unless it collides; (h, sha) is then one content each
    by_len = rows.groupBy("h", "sha", "len").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    groups = stage(by_len.groupBy("h", "sha").agg(F.sum("n").alias("n"), F.max("len").alias("keep_len"),
                                                  F.max_by("id", "len").alias("keep_id")).where("n > 1"), "dedup-groups")
    unstage(many)
    return rows, groups


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash128: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``."""
    rows, groups = content_groups(docs, id_col, text_col, hash128)
    # both sides are stored tables: AQE splits the partition of a hot group
    out = rows.join(groups, ["h", "sha"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return out.select(F.col("id").alias(id_col), keep.alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all its columns) without copies: the row that stays of every
    group, once even when that row is repeated.

    What goes is decided on narrow stored tables. The groups are broadcast while
    they are at most ``SMALL_GROUPS``, so that no text is shuffled; beyond, both
    sides are shuffled by the hash. Only groups whose staying row is repeated
    take a second look."""
    rows, groups = content_groups(docs, id_col, text_col)
    # how often the staying row itself occurs
    mine = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("len") == F.col("keep_len"))
    kept = rows.join(groups, ["h", "sha"]).where(mine).groupBy("h", "sha", "keep_id", "keep_len").agg(F.count(F.lit(1)).alias("times"))
    stays = stage(kept.select(F.col("h").alias("__h"), F.col("sha").alias("__sha"), F.col("keep_id").alias("__keep_id"),
                              F.col("keep_len").alias("__keep_len"), (F.col("times") > 1).alias("__again")), "dedup-stays")
    unstage(rows, groups)
    norm = normalised(F.col(text_col))
    tagged = docs.withColumns({"__h": md5_128(norm), "__sha": F.unhex(F.sha2(norm, 256)),
                               "__len": F.length(F.coalesce(F.col(text_col), F.lit("")))})
    side = sized_broadcast(stays, SMALL_GROUPS)
    # otherwise a hash join on the narrow side, so the texts are not sorted
    out = tagged.join(side if side is not stays else stays.hint("shuffle_hash"), ["__h", "__sha"], "left")
    own = F.col(id_col).eqNullSafe(F.col("__keep_id")) & (F.col("__len") == F.col("__keep_len"))
    left = out.where(F.col("__keep_len").isNull() | own)
    if stays.where("__again").isEmpty():
        return left.select(*docs.columns)
    again = F.coalesce("__again", F.lit(False))
    return left.where(~again).select(*docs.columns).unionByName(
        left.where(again).dropDuplicates(["__h", "__sha"]).select(*docs.columns))


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
k as (
  select *, first_value(doc_id) over (partition by norm order by n desc, doc_id) as keep_id,
         count(*) over (partition by norm) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from k
"""
