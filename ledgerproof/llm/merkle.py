"""Merkle manifest of a dataset: one digest for the whole, one short proof for every document.

A document's leaf is the SHA-256 of its columns, each with its length. Per source the leaves ascend by doc_id and
every ``ARITY`` consecutive nodes become one, level by level, up to the source's subroot; the subroots, by source,
become the root in the same way.

Method: concatenated-level strings. ``BLOCK`` = ARITY^DEPTH consecutive nodes are one aligned block, and a block keeps
each of its levels as one string of hex digests. Fixed-width substrings of a level hash to the parents, the next
level's string; the substrings that flank a node inside its run are its siblings. Block roots are the leaves of the
next round, so a tree of n leaves takes log(n) / log(BLOCK) rounds. All of it is DataFrame functions.

Scale: texts are hashed where they are read and never shuffled; what moves is one slim row per document, once to its
place (``common.positions``: a source with a third of all rows is spread over ranges) and once to its block, of
BLOCK rows at most. Proofs go down from blocks, one row per block, into the rows a block explodes to.

Defined results: NULL columns hash as ``-``; NULL doc_ids come first, equal doc_ids by leaf, equal rows are leaves of
their own; a NULL source is a source, the first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, written

ARITY = 3
DEPTH = 5
BLOCK = ARITY**DEPTH
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def _h(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row's columns, in the order given: ``-`` or the UTF-8 length, a colon and the value."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return _h(F.concat(*parts))


def _parents(level: Column) -> Column:
    """The next level's string: every ARITY digests, the last run what is left, hash to one."""
    width = ARITY * _HEX
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int"))
    return F.array_join(F.transform(runs, lambda k: _h(F.substring(level, k * width + 1, F.lit(width)))), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, node, n: the tree's nodes) -> one row per block: tree, block, n, levels, root."""
    digests = F.transform(F.array_sort(F.collect_list(F.struct("pos", "node"))), lambda x: x["node"])
    out = nodes.groupBy("tree", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_join(digests, "").alias("l0"))
    for k in range(DEPTH):  # a tree of ARITY^k nodes or fewer ends at level k, any other block at its root
        higher = F.when(F.col("n") > ARITY**k, _parents(F.col(f"l{k}")))
        out = out.withColumn(f"l{k + 1}", higher)
    levels = F.filter(F.array(*[F.col(f"l{k}") for k in range(DEPTH + 1)]), lambda x: x.isNotNull())
    return out.select("tree", "n", "block", levels.alias("levels")).select(
        "tree", "n", "block", F.slice("levels", F.lit(1), F.size("levels") - 1).alias("levels"),
        F.element_at("levels", -1).alias("root"))


def _flanks(levels: Column, pos: Column) -> Column:
    """The siblings of the node at ``pos`` in its block, level by level, left and right of it."""
    def at(level: Column, k: Column) -> Column:
        index = F.floor(pos / F.pow(F.lit(ARITY), k)).cast("int")
        begin = index - index % ARITY
        left = F.substring(level, begin * _HEX + 1, (index - begin) * _HEX)
        right = F.substring(level, (index + 1) * _HEX + 1, (begin + (ARITY - 1) - index) * _HEX)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(levels, at)


def trees(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, node) -> a row per block of BLOCK nodes: tree, block, levels, top (siblings above the
    block, to the tree's root) and root. Written."""
    counts = nodes.groupBy(F.col("tree").alias("_t")).agg(F.count("*").alias("n"))
    nodes = nodes.join(counts, F.col("tree").eqNullSafe(F.col("_t"))).select("tree", "n", "pos", "node")
    rounds = [written(_blocks(nodes), "merkle-blocks")]
    while (rounds[-1].agg(F.max("block")).first()[0] or 0) > 0:
        nodes = rounds[-1].select("tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"),
                                  F.col("root").alias("node"))
        rounds.append(written(_blocks(nodes), "merkle-blocks"))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    done = rounds.pop().withColumn("top", nothing)
    while rounds:
        above = done.select(F.col("tree").alias("_t"), F.col("block").alias("_b"), F.col("levels").alias("_levels"),
                            F.col("top").alias("_top"), F.col("root").alias("_root"))
        below = rounds.pop().drop("root")
        here = F.col("tree").eqNullSafe(F.col("_t")) & (F.floor(F.col("block") / BLOCK) == F.col("_b"))
        done = below.join(above, here).select("tree", "block", "levels", F.concat(
            _flanks(F.col("_levels"), F.col("block") % BLOCK), F.col("_top")).alias("top"), F.col("_root").alias("root"))
    return written(done.select("tree", "block", "levels", "top", "root"), "merkle-trees")


def folded(path: Column, node: Column) -> Column:
    """The root that ``node`` leads to along ``path``."""
    return F.aggregate(path, node, lambda acc, x: _h(F.concat(x["left"], acc, x["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, tampered (a second leaf, NULL where there is none), subroot, root, path.

    ``tampered`` is a text to stand for ``text`` in the second leaf, or NULL."""
    own = {c: F.col(c) for c in COLUMNS}
    second = F.when(tampered.isNotNull(), leaf({**own, "text": tampered})) if tampered is not None else F.lit(
        None).cast("string")
    leaves = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias(
        "source"), leaf(own).alias("leaf"), second.alias("tampered"), F.monotonically_increasing_id().alias("_row")),
        "merkle-leaves")
    placed = written(positions(leaves, ["source"], ["doc_id", "leaf", "_row"], "merkle-order"), "merkle-places")
    per = trees(placed.select(F.col("source").alias("tree"), "pos", F.col("leaf").alias("node")))
    subroots = per.where("block = 0").select(F.col("tree").alias("source"), F.col("root").alias("node"))
    ranked = written(positions(subroots, [], ["source"], "merkle-sources").withColumn("tree", F.lit(0)), "merkle-subroots")
    whole = trees(ranked.select("tree", "pos", "node"))
    top = ranked.join(whole.drop("tree"), F.floor(F.col("pos") / BLOCK) == F.col("block")).select(
        F.col("source").alias("_s"), F.col("root").alias("root"),
        F.concat(_flanks(F.col("levels"), F.col("pos") % BLOCK), F.col("top")).alias("_above"))
    blocks = per.join(top, F.col("tree").eqNullSafe(F.col("_s"))).select(
        F.col("tree").alias("_t"), F.col("block").alias("_b"), "levels", per["root"].alias("subroot"), top["root"].alias(
            "root"), F.concat("top", "_above").alias("_rest"))
    members = placed.groupBy("source", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.collect_list(F.struct("pos", "doc_id", "leaf", "tampered")).alias("members"))
    both = members.join(blocks, F.col("source").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_b")))
    each = both.select("source", "levels", "subroot", "root", "_rest", F.explode("members").alias("m"))
    return each.select(F.col("m.doc_id").alias("doc_id"), "source", F.col("m.leaf").alias("leaf"), F.col(
        "m.tampered").alias("tampered"), "subroot", "root", F.concat(
            _flanks(F.col("levels"), F.col("m.pos") % BLOCK), F.col("_rest")).alias("path"))


def digest(docs: DataFrame) -> DataFrame:
    """The manifest with every proof folded: every second document's text loses its line ends and must not verify."""
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 != 0
    cut = F.when(F.coalesce(~odd, F.lit(False)), F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))
    rows = manifest(docs, cut)
    end = folded(F.col("path"), F.coalesce("tampered", "leaf"))
    return rows.select("doc_id", "leaf", "subroot", "root", _h(siblings(F.col("path"))).alias("proof_sha256"),
                       end.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Unsigned CRC-32 of an ASCII text, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))),
  4294967295::bigint)"""

_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in COLUMNS) + ")"

ORACLE = f"""
with recursive base as (
  select row_number() over () as r, *, {_LEAF} as leaf, {CRC32.format("doc_id::varchar")} % 2 = 0 as cut from documents),
leaves as (
  select *, (select {_LEAF} from (select b.doc_id as doc_id, b.source as source, b.lang as lang, b.n_chars as n_chars,
                                         replace(b.text, chr(10), '') as text)) as other,
         row_number() over (partition by source order by doc_id nulls first, leaf, r) - 1 as p,
         count(*) over (partition by source) as n
  from base b),
lev(source, k, i, h, n) as (
  select source, 0, p, leaf, n from leaves
  union all
  select source, k + 1, i // 3, sha256(string_agg(h, '' order by i)), (n + 2) // 3 from lev where n > 1
  group by source, k, i // 3, n),
subs as (select source, h as subroot, row_number() over (order by source nulls first) - 1 as p, count(*) over () as n
         from lev where n = 1),
up(k, i, h, n) as (
  select 0, p, subroot, n from subs
  union all
  select k + 1, i // 3, sha256(string_agg(h, '' order by i)), (n + 2) // 3 from up where n > 1 group by k, i // 3, n),
heights as (select source, max(k) as height from lev group by source),
nodes as (
  select 0 as upper, source, k, i, h, n from lev
  union all select 1, null, k, i, h, n from up),
steps as (
  select a.upper, a.source, a.k, a.i,
         coalesce(string_agg(b.h, '' order by b.i) filter (where b.i < a.i), '') as l,
         coalesce(string_agg(b.h, '' order by b.i) filter (where b.i > a.i), '') as r
  from nodes a join nodes b on a.upper = b.upper and a.source is not distinct from b.source and a.k = b.k
       and a.i // 3 = b.i // 3
  where a.n > 1 group by a.upper, a.source, a.k, a.i),
path as (
  select v.r as row_id, s.k, s.l, s.r from leaves v join steps s
    on s.upper = 0 and s.source is not distinct from v.source and s.i = v.p // power(3, s.k)::bigint
  union all
  select v.r, t.height + s.k, s.l, s.r from leaves v join subs u on u.source is not distinct from v.source
    join heights t on t.source is not distinct from v.source
    join steps s on s.upper = 1 and s.i = u.p // power(3, s.k)::bigint),
proofs as (select row_id, string_agg(l || r, '' order by k) as proof from path group by row_id),
fold(row_id, k, node) as (
  select r, 0, case when cut then coalesce(other, leaf) else leaf end from leaves
  union all
  select f.row_id, f.k + 1, sha256(p.l || f.node || p.r) from fold f join path p on p.row_id = f.row_id and p.k = f.k),
ends as (select row_id, arg_max(node, k) as folded_root from fold group by row_id)
select v.doc_id, v.leaf, u.subroot, (select h from up where n = 1) as root, sha256(coalesce(q.proof, '')) as proof_sha256,
       e.folded_root, e.folded_root = (select h from up where n = 1) as verified
from leaves v join subs u on u.source is not distinct from v.source
join ends e on e.row_id = v.r left join proofs q on q.row_id = v.r
"""
