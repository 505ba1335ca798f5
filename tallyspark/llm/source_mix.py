r"""Mixing sources to target weights by Pareto order sampling.

Sources are ordered by code point, null last, and weigh ``weights`` in turn.
They share ``share`` times the words of all documents; a target stops at
``max_copies`` times its source's words and the excess is shared again by
weight until none is above (solved in closed form: sources are capped in the
order of cap / weight).

Inside a source with words ``S`` and target ``T`` every document gets
``floor(T / S)`` certain copies. The rest, ``F`` words, is an unequal-probability
sample: inclusion odds follow the size, ``p = min(1, c * size)`` with ``c`` such
that the expected words are ``F``. Pareto order sampling ranks documents by
``(u / (1 - u)) / (p / (1 - p))``, ``u`` being a hash of the id, and takes them
in this order while the middle of the document lies within ``F``, so the sample
has a fixed size in words, up to half of one document. The same input gives the
same sample; repeated rows (same id) have the same rank.

Shape at scale: only DataFrame functions. The text is read once for its word
count. A source's cut is found from the word sums of ``BUCKETS`` rank buckets,
combined map-side; only the one bucket that holds the cut is sorted, so a
source with a third of all rows is never in one task. Source tables are small
and joined by the planner's own size check.

Cases: null and empty texts have size 0 and take nothing; null sources are one
source, the last; null ids draw one common random number. An empty table gives
an empty result. Extra columns are carried through by ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import WORD, table, word_count
from tallyspark.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
BUCKETS = 4096
SEED = "mix"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``. One row
    per source is ordered in a single window, after the sums."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    src = src.withColumn("w", weight).withColumn("cap", F.lit(max_copies) * F.col("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    total = F.lit(share) * F.sum("source_size").over(every)
    capped_before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_from = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    src = src.withColumn("k", (total - capped_before) / weight_from)
    # the first source, in this order, that its share does not fill to the cap
    free = F.when(F.col("k") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("k")))
    src = src.withColumn("level", F.min(free).over(every)["k"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return src.select("source", "source_size", target.alias("target"))


def random_unit(id_col: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the id: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _sampling_plan(sizes: DataFrame, **kw) -> DataFrame:
    """Per source: target, certain copies ``whole``, words ``rest`` of the
    sample and the odds factor ``c``."""
    src = source_targets(sizes, **kw)
    ratio = F.col("target") / F.col("source_size")
    src = src.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0).cast("long"))
    src = stage(src.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-sources")
    by_size = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    above = F.coalesce(F.sum(F.col("n") * F.col("size")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum(F.col("n") * F.col("size") * F.col("size")).over(
        down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    by_size = by_size.withColumns({"above": above, "squares": squares}).withColumnRenamed("source", "s")
    cut = by_size.join(src.select("source", "rest"), F.col("s").eqNullSafe(F.col("source")))
    c = (F.col("rest") - F.col("above")) / F.col("squares")
    cut = cut.withColumn("c", c).where((F.col("c") >= 0) & (F.col("c") * F.col("size") <= 1))
    cut = cut.groupBy("s").agg(F.max_by("c", "size").alias("c"))
    return stage(src.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
                 .select("source", "source_size", "target", "whole", "rest", F.coalesce("c", F.lit(0.0)).alias("c")),
                 "mix-plan")


def _ranked(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Rows ``(__id, __source, __size, ...)`` with their plan, Pareto rank and
    rank bucket (-1: certain; null: never drawn)."""
    p = F.col("__c") * F.col("__size")
    u = F.col("__u")
    q = F.when(p < 1, (u / (1 - u)) / (p / (1 - p))).otherwise(0.0)
    drawn = (F.col("__size") > 0) & (F.col("__rest") > 0) & (F.col("__c") > 0)
    plan = plan.select(*[F.col(c).alias(f"__{'key' if c == 'source' else c}") for c in plan.columns])
    return (rows.join(plan, F.col("__source").eqNullSafe(F.col("__key")), "left")
            .withColumn("__u", random_unit(F.col("__id"), seed))
            .withColumn("__q", F.when(drawn, q))
            .withColumn("__bucket", F.when(drawn, F.when(p >= 1, -1).otherwise(
                F.floor(F.lit(BUCKETS) * (F.col("__q") / (1 + F.col("__q")))).cast("int")))))


def _with_copies(rows: DataFrame, plan: DataFrame, cuts: DataFrame, seed: str) -> DataFrame:
    cuts = cuts.select(F.col("source").alias("__cut_key"), "__cut", "__before")
    r = _ranked(rows, plan, seed).join(cuts, F.col("__source").eqNullSafe(F.col("__cut_key")), "left")
    at_cut = F.col("__bucket").isNotNull() & (F.col("__bucket") == F.col("__cut"))
    extra = F.when(F.col("__bucket").isNotNull() & (F.col("__cut").isNull() | (F.col("__bucket") < F.col("__cut"))), 1)
    clear = r.where(~F.coalesce(at_cut, F.lit(False))).withColumn("__extra", extra.otherwise(0))
    tie = ["__row"] if "__row" in r.columns else []
    order = (Window.partitionBy("__source").orderBy("__q", "__id", "__size", *tie)
             .rowsBetween(Window.unboundedPreceding, -1))
    taken = F.col("__before") + F.coalesce(F.sum("__size").over(order), F.lit(0)) + F.col("__size") / 2 <= F.col("__rest")
    edge = r.where(F.coalesce(at_cut, F.lit(False))).withColumn("__extra", F.when(taken, 1).otherwise(0))
    return clear.unionByName(edge).withColumn("__copies", F.coalesce(F.col("__whole"), F.lit(0)) + F.col("__extra"))


def mix(rows: DataFrame, payload: DataFrame | None = None, seed: str = SEED, **kw) -> DataFrame:
    """Copies per document. ``rows``: ``(__id, __source, __size)``, a stored
    table; ``payload`` (default ``rows``) has the same columns and any others,
    which are kept. Adds ``__copies``, ``__source_size`` and ``__target``."""
    sizes = rows.select(F.col("__source").alias("source"), F.col("__size").alias("size"))
    plan = _sampling_plan(sizes, **kw)
    sums = (_ranked(rows, plan, seed).where(F.col("__bucket").isNotNull())
            .groupBy("__source", "__bucket", "__rest").agg(F.sum("__size").alias("words")))
    order = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    # the last bucket that begins within the words to draw holds the cut; the
    # certain ones (-1) never do
    cut = sums.where((F.col("__bucket") >= 0) & (F.col("__before") <= F.col("__rest")))
    none = sums.groupBy("__source").agg(F.max("__bucket").alias("last"))
    cut = cut.groupBy("__source").agg(F.max_by("__before", "__bucket").alias("__before"),
                                      F.max("__bucket").alias("__cut"))
    cut = none.withColumnRenamed("__source", "source").join(
        cut, F.col("source").eqNullSafe(F.col("__source")), "left").where(F.col("last") >= 0)
    # no bucket begins within them: the certain documents filled them all
    cuts = stage(cut.select("source", F.coalesce("__cut", F.lit(0)).alias("__cut"),
                            F.coalesce("__before", F.lit(1 << 62)).alias("__before")), "mix-cuts")
    return _with_copies(rows if payload is None else payload, plan, cuts, seed)


def _sized(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                       word_count(F.col("text")).alias("__size"))


def mixture(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (words taken, repeats
    counted) and ``copies`` per row of ``docs``."""
    out = mix(stage(_sized(docs), "mix-rows"), **kw)
    return out.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"),
                      F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                      (F.col("__copies") * F.col("__size")).alias("taken"), F.col("__copies").alias("copies"))


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` (all its columns, whatever their names), every row as often as
    the mix takes it. Of rows with one id and size (or none) the lowest hashes
    of the whole row come first, so reruns agree."""
    rows = stage(_sized(docs), "mix-rows")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = mix(rows, _sized(docs, whole.alias("__doc"), F.xxhash64(whole).alias("__row")), **kw)
    return (out.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))))
            .select("__doc.*"))


def op2_source_mix(spark, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def mix_sql(docs: str) -> str:
    """DuckDB SQL of the same rule over the relation ``docs``: a list of CTEs
    ending in ``mixed`` (the row number ``rn``, sizes, targets and copies)."""
    return rf"""
sized as (select row_number() over () as rn, doc_id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as bigint) as size from {docs}),
src0 as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
src1 as (select *, case (row_number() over (order by source asc nulls last) - 1) % 3
    when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w, 2 * source_size as cap from src0),
src2 as (select *, (1.5::double * sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / w, source asc nulls last
          rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by cap / w, source asc nulls last rows between current row and unbounded following) as k from src1),
src3 as (select *, (select arg_min(k, cap / w) from src2 where k * w <= cap) as level from src2),
src4 as (select source, source_size,
    case when level is null then cap::double else least(level * w, cap::double) end as target from src3),
src5 as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from src4),
src6 as (select *, target - whole * source_size as rest from src5),
bys as (select source, size, count(*) as n from sized where size > 0 group by all),
cum as (select *, coalesce(sum(n * size) over (partition by source order by size desc
      rows between unbounded preceding and 1 preceding), 0)::double as above,
    (sum(n * size * size) over (partition by source order by size desc
      rows between current row and unbounded following))::double as squares from bys),
cand as (select cum.source, size, (rest - above) / squares as c
    from cum join src6 on cum.source is not distinct from src6.source),
fac as (select source, arg_max(c, size) as c from cand where c >= 0 and c * size <= 1 group by source),
ranked as (select sized.*, source_size, target, whole, rest, coalesce(fac.c, 0) as c,
    (cast('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 13) as bigint) + 0.5::double)
      / 4503599627370496.0::double as u
    from sized join src6 on sized.source is not distinct from src6.source
    left join fac on sized.source is not distinct from fac.source),
odds as (select *, case when size > 0 and rest > 0 and c > 0 then
    case when c * size < 1 then (u / (1 - u)) / ((c * size) / (1 - c * size)) else 0 end end as q,
    c * size >= 1 as sure from ranked),
ordered as (select *, coalesce(sum(size) over (partition by source order by q is null, sure desc, q, doc_id, size
      rows between unbounded preceding and 1 preceding), 0) as before from odds),
mixed as (select *, whole + case when q is not null and (sure or before + size / 2.0::double <= rest) then 1 else 0 end as copies
    from ordered)"""


ORACLE = f"""with {mix_sql('documents')}
select doc_id, size, source_size, target, copies * size as taken, copies from mixed
"""
