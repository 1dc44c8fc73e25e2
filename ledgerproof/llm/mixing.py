"""Mixing sources to target weights, DataFrame operations only.

Sources, ranked by code point with NULL last, carry the weights 5, 2, 1, 5, 2, 1, ... and share
``share`` x all words; a target stops at ``epochs`` x its source's words and the excess is shared again by
weight. That fixed point is closed: with caps c and weights w, every target is min(c, level * w) and level is the
largest (total - caps of the first k) / (weights after the first k), sources taken in order of c / w.

A source's budget is met exactly: every document is taken (budget div source size) times, and the rest of the
budget goes to the documents in the order of a random key (an MD5 of seed, id and text). Per source the keys are
ranged into about sqrt(rows) buckets; word counts are summed per bucket, a prefix sum over buckets finds the
bucket where the budget ends, and a prefix sum inside that one bucket finds the key. So only word counts are
shuffled, partly summed first; no source, however hot, lands in a task beyond sqrt(its rows), and documents meet
the cut, one row per source, without moving themselves. Rows that share the key at a cut are numbered by ranges, so a
third of all rows may be equal. Sources are ranked and their caps summed by ranges as well, so there may be as many
as web hosts; the driver sees three numbers: all words, all weights, the level.

Defined results: NULL text has size 0 and NULL source is a source; the document at the cut gives its first words
only; rows that are equal in id and text share a key, and where the cut falls on it they give what is left one after
the other, so the budget is met by them, too; a source without words has target 0; an empty table gives no rows; other
columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, positions, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"


def _key(seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).cast("binary"))


def _range(key: str) -> Column:
    """The key's first eight hex digits as a number below 2^32: keys in order fall in order."""
    return F.conv(F.substring(F.col(key), 1, 8), 16, 10).cast("long")


def _before(df: DataFrame, order: list[Column], sums: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``pos``, a row's place from 0 by ``order``, and per column of ``sums`` its sum over all earlier rows.

    Rows are sorted by ranges: sums inside a range, plus a prefix sum of one row per range. Written. ``order`` should
    tell all rows apart."""
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()), "mix-order").withColumn("_part", F.shiftright("_at", 33))
    counted = {"pos": F.lit(1).cast("long"), **{f"{c}_before": F.col(c) for c in sums}}
    ranges = placed.groupBy("_part").agg(*[F.sum(x).alias(f"_{name}") for name, x in counted.items()])
    earlier = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_part", *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}")
                                      for name in counted])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(ranges, "_part").select(*df.columns, *[
        (F.coalesce(F.sum(x).over(inside), F.lit(0)) + F.col(f"_{name}")).alias(name) for name, x in counted.items()])


def targets(sized: DataFrame, *, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source, rows, source_size, target, full (whole epochs), rest (words of the last)."""
    per = sized.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (F.pmod(F.col("pos"), F.lit(len(weights))) + 1).cast("int"))
    ranked = _before(per, [F.col("source").asc_nulls_last()]).withColumn("weight", weight).drop("pos")
    ranked = ranked.withColumn("cap", F.col("source_size") * epochs)
    ordered = written(_before(ranked, [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()],
                              ("cap", "weight")), "mix-levels")
    words, weighed = ordered.agg(F.sum("source_size"), F.sum("weight")).first()  # one row of two numbers
    level = ordered.agg(F.max((F.lit(float((words or 0) * share)) - F.col("cap_before"))
                              / (F.lit(weighed or 0) - F.col("weight_before")))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level or 0.0) * F.col("weight"))
    budget = F.floor(F.col("target") + 0.5)
    size = F.greatest(F.col("source_size"), F.lit(1))
    return ordered.withColumn("target", target).select(
        "source", "rows", "source_size", "target",
        F.floor(budget / size).alias("full"), F.pmod(budget, size).alias("rest"))


def cuts(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """``per_source`` with the key at which its rest ends and the words left there, for all rows that share it.

    Keys below ``cut`` are taken once more. ``cut`` is NULL where nothing is left after whole epochs."""
    side = per_source.select(F.col("source").alias("_s"), "rows", "rest").where("rest > 0")
    spread = F.ceil(F.sqrt("rows"))
    placed = sized.join(side, sized["source"].eqNullSafe(F.col("_s"))).withColumn(
        "_bucket", F.floor(_range("key") * spread / F.lit(float(1 << 32))).cast("long"))
    sums = placed.groupBy("_s", "rest", "_bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_upto", F.sum("words").over(upto))
    ends = sums.where("_upto >= rest and _upto - words < rest").select(
        F.col("_s").alias("_e"), F.col("_bucket").alias("_eb"), (F.col("rest") - F.col("_upto") + F.col("words")).alias(
            "_left"))
    inside = placed.join(ends, placed["_s"].eqNullSafe(F.col("_e")) & (F.col("_bucket") == F.col("_eb")))
    keys = inside.groupBy("_s", "_left", "key").agg(F.sum("size").alias("words"))
    within = Window.partitionBy("_s").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    keys = keys.withColumn("_upto", F.sum("words").over(within))
    found = keys.where("_upto >= _left and _upto - words < _left").select(
        F.col("_s").alias("_c"), F.col("key").alias("cut"),
        (F.col("_left") - F.col("_upto") + F.col("words")).alias("at_cut"))
    return per_source.join(found, per_source["source"].eqNullSafe(F.col("_c")), "left").drop("_c", "rows", "rest")


def _plan(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    seed = how.pop("seed", SEED)
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias(
        "source"), word_count(F.col("text")).alias("size"), _key(seed).alias("key")), "mix-sizes")
    plan = written(cuts(sized, targets(sized, **how)), "mix-cuts")
    return sized, plan.withColumnRenamed("source", "_source")


def _at_cut() -> Column:
    return F.coalesce(F.col("key") == F.col("cut"), F.lit(False))


def _shared_out(rows: DataFrame) -> DataFrame:
    """Rows at their source's cut (held, source, key, size, at_cut) with ``extra``: what each gives of the words left
    there, the first ones all of theirs, one a part, the others nothing. The rows of one cut are alike."""
    numbered = positions(rows.withColumn("row", F.monotonically_increasing_id()), ["source"], ["row"], "mix-at-cut")
    left = F.col("at_cut") - F.col("pos") * F.col("size")
    return numbered.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))


def mix_sizes(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken: the mix as word counts, from the written sizes alone."""
    sized, plan = _plan(docs, **how)
    both = sized.join(plan, sized["source"].eqNullSafe(F.col("_source")))
    columns = ["doc_id", "size", "source_size", "target"]
    plain = both.where(~_at_cut()).select(*columns, F.expr(
        "full * size + case when key < cut then size else 0 end").alias("taken"))
    ends = _shared_out(both.where(_at_cut()).select(F.struct(*columns, "full").alias("held"), "source", "size", "at_cut"))
    return plain.union(ends.select("held.doc_id", "size", "held.source_size", "held.target", (
        F.col("held.full") * F.col("size") + F.col("extra")).alias("taken")))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents, all columns as they came: each row once per epoch that takes it.

    A row at its source's cut that is taken in part is given with its first words, joined by single spaces."""
    _, plan = _plan(docs, **how)
    # the caller's columns travel inside one struct, so none of their names can meet the ones used here
    held = docs.select(_key(how.get("seed", SEED)).alias("key"), F.col("source").cast("string").alias("source"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"))
    both = held.join(plan, held["source"].eqNullSafe(F.col("_source")))
    size = word_count(F.col("held.text"))
    plain = both.where(~_at_cut()).select("held", (F.col("full") + F.coalesce(
        (F.col("key") < F.col("cut")).cast("long"), F.lit(0))).alias("copies"), F.lit(0).cast("long").alias("part"))
    ends = _shared_out(both.where(_at_cut()).select("held", "source", size.alias("size"), "at_cut", "full"))
    partly = F.when(F.col("extra") < F.col("size"), F.col("extra")).otherwise(0)
    ends = ends.select("held", (F.col("full") + (F.col("extra") > 0).cast("long")).alias("copies"), partly.alias("part"))
    each = plain.union(ends).select("held", "copies", "part", F.explode(F.when(
        F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), "copies"))).alias("copy"))
    words = F.regexp_extract_all("held.text", F.lit(WORD), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("part"), F.lit(1)).cast("int")), " ")
    cut_here = (F.col("part") > 0) & (F.col("copy") == F.col("copies"))
    new = {"text": F.when(cut_here, first).otherwise(F.col("held.text"))}
    if "n_chars" in docs.columns:
        chars = F.length(first).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(cut_here, chars).otherwise(F.col("held.n_chars"))
    return each.select(*[new.get(c, F.col(f"held.`{c}`")).alias(c) for c in docs.columns])


ORACLE = r"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5('mix-1|' || coalesce(cast(doc_id as varchar), 'null') || '|' || md5(coalesce(text, ''))) as key
  from documents),
per as (
  select source, cast(sum(size) as bigint) as source_size,
         case (row_number() over (order by source asc nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from sized group by source),
levels as (
  select *, (1.5 * sum(source_size) over () - coalesce(sum(2 * source_size) over earlier, 0))
         / (sum(w) over () - coalesce(sum(w) over earlier, 0)) as lv
  from per window earlier as (order by 2 * source_size / w, source asc nulls last
                              rows between unbounded preceding and 1 preceding)),
goals as (
  select source, source_size, least(2.0 * source_size, cast(max(lv) over () as double) * w) as target from levels),
budgets as (
  select *, cast(floor(target + 0.5) as bigint) // greatest(source_size, 1) as full_epochs,
         cast(floor(target + 0.5) as bigint) % greatest(source_size, 1) as rest from goals),
keyed as (
  select s.*, sum(size) over (partition by source order by key range unbounded preceding) as upto,
         sum(size) over (partition by source, key) as here, row_number() over (partition by source, key) as rank_here
  from sized s)
select k.doc_id, k.size, b.source_size, cast(b.target as double) as target,
       cast(b.full_epochs * k.size + case when k.upto <= b.rest then case when b.rest > 0 then k.size else 0 end
            when k.upto - k.here < b.rest
            then greatest(0, least(k.size, b.rest - k.upto + k.here - (k.rank_here - 1) * k.size)) else 0 end as bigint) as taken
from keyed k join budgets b on k.source is not distinct from b.source
"""
