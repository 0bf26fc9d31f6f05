"""Prefix trie of conversations, with subtree totals by a depth-band rollup.

Turns are put in order (``turn``, null first; ties by role, then by the turn's
digest) and every conversation is rebuilt on the head of its family's first
member. A node - a distinct sequence of first turns - is named by 128 bits: the
exclusive or of one keyed hash per (position, role, text), so that prefixes of a
long conversation can be summed in parts.

Subtree totals: depths are cut into bands of ``HEIGHT``. Inside a band a node
adds its value to each of its ancestors there (``HEIGHT`` rows at most), which
completes the totals as far as the band goes. The band's top nodes form a tree
of their own, ``HEIGHT`` times less deep, with those totals as values; the same
rollup over it gives the tops' whole subtree totals, and each top then adds its
total to the nodes above it in the band before. A tree of depth D thus takes
2 log(D) / log(HEIGHT) rounds of one ``explode`` and one aggregation each, and no
node is ever multiplied by more than ``HEIGHT``.

Skew: turns are ranked by range: range partitions are ranked by themselves, and
offsets are summed over the (conversation, partition) totals, so a conversation
with a third of all turns is spread over many tasks; its ancestors are gathered in
blocks of ``HEIGHT`` positions. Popular nodes (first turns) are counted with
partial sums. The children of a node with many are salted where they fetch
their parent's id. The hash of a node's ends reads its ids as one byte stream:
ids are sorted by range, joined to pieces of ``PIECE`` ids in parallel, and only
the pieces of a node pass through one task, in order, with constant memory.

Defined results: null role and text are empty; rows without a conv_id belong to no
conversation and are left out; repeated rows are turns of their own; an empty table
gives an empty trie (no root); extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirescope.llm import common as C

HEIGHT = 8
FAMILY = 20
HEADS = 4
SPLIT = 1_000  # children of one parent that meet in a task
PIECE = 4_096  # ids of a node's end that are joined to one string
NODE = ("a", "b")  # the two halves of a node's name


def family_of(conv: Column) -> Column:
    """The conversation whose head the family shares."""
    return conv - conv % FAMILY


def head_turns(conv: Column) -> Column:
    """How many of a conversation's turns are replaced by its family's head."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def _xor(x: str | Column, w: W | None = None) -> Column:
    s = F.bit_xor(x)
    return F.coalesce(s.over(w) if w is not None else s, F.lit(0).cast("long"))


def ranked(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, rank, d1, d2, words) per turn and (conv_id, part, before, size) per conversation and part.

    ``part`` numbers range partitions: rank - before is the rank in the part.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    md5 = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        # 60 bits of each half of the digest
        *[F.conv(F.substring(md5, at, 15), 16, 10).cast("long").alias(d) for d, at in (("d1", 1), ("d2", 17))],
        md5.alias("digest"), C.n_words(text).alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    dealt = C.stored(rows.repartitionByRange(F.col("conv_id").asc(), *order)
                     .withColumn("part", F.spark_partition_id()), "trie-turns")
    local = dealt.withColumn("at", F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order)))
    local = C.stored(local.select("conv_id", "part", "at", "d1", "d2", "words"), "trie-local")
    sizes = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # at most one row per range partition of a conversation
    by = W.partitionBy("conv_id")
    parts = sizes.select("conv_id", "part",
                         (F.sum("n").over(by.orderBy("part")) - F.col("n")).alias("before"),
                         F.sum("n").over(by).alias("size"))
    return local, C.stored(parts, "trie-parts")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, pa, pb, words, is_end): the nodes on every rebuilt conversation's path, root included."""
    local, parts = ranked(turns)
    key = ["conv_id", "part"]
    own = local.join(parts, key).withColumn("rank", F.col("before") + F.col("at"))
    # the first HEADS - 1 turns of each family's first member
    heads = (own.filter((F.col("rank") < HEADS) & (F.col("conv_id") % FAMILY == 0)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "d1", "d2", "words"))).alias("head"))
             .select(F.col("conv_id").alias("family"), "head"))
    convs = (parts.groupBy("conv_id").agg(F.max("size").alias("size"))
             .withColumn("family", family_of(F.col("conv_id"))).join(heads, "family", "left")
             .withColumn("h", head_turns(F.col("conv_id")))
             .withColumn("head", F.when(F.col("head").isNull(), F.expr("slice(array(struct(0L as rank, 0L as d1, 0L as d2, 0L as words)), 1, 0)"))
                         .otherwise(F.slice("head", F.lit(1), F.col("h"))))
             .withColumn("len", F.size("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "head", "len", F.size("head").alias("m")))
    convs = C.stored(convs, "trie-convs")

    def named(df: DataFrame) -> DataFrame:
        return (df.withColumn("a", F.xxhash64("pos", "d1", "d2"))
                .withColumn("b", F.xxhash64("d2", F.lit(7), "d1", "pos")))

    # the shared head (at most HEADS - 1 rows a conversation) counts as a part before all others
    first = convs.select("conv_id", "len", "h", "m", F.lit(-1).alias("part"), F.posexplode("head").alias("i", "t")).select(
        "conv_id", "part", "len", (F.col("i") + 1).cast("long").alias("pos"), "t.d1", "t.d2", "t.words")
    # h, m and len per (conversation, part), so that a long conversation's turns meet them dealt
    spread = parts.join(convs.drop("head"), "conv_id")
    rest = local.join(spread, key).withColumn("rank", F.col("before") + F.col("at")).filter("rank > h").select(
        *key, "len", (F.col("rank") - F.col("h") + F.col("m")).alias("pos"), "d1", "d2", "words")
    path = C.stored(named(first.unionByName(rest)).drop("d1", "d2"), "trie-path")
    sums = path.groupBy(*key).agg(_xor("a").alias("sa"), _xor("b").alias("sb"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*key, _xor("sa", before).alias("oa"), _xor("sb", before).alias("ob"))
    upto = W.partitionBy(*key).orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = path.join(sums, key).select(
        "conv_id", "pos", "words", "len", F.col("a").alias("ka"), F.col("b").alias("kb"),
        _xor("a", upto).bitwiseXOR(F.col("oa")).alias("a"), _xor("b", upto).bitwiseXOR(F.col("ob")).alias("b"))
    zero = F.lit(0).cast("long")
    nodes = whole.select("conv_id", "pos", "a", "b", F.col("a").bitwiseXOR(F.col("ka")).alias("pa"),
                         F.col("b").bitwiseXOR(F.col("kb")).alias("pb"), "words", (F.col("pos") == F.col("len")).alias("is_end"))
    root = convs.select("conv_id", zero.alias("pos"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("pa"),
                        F.lit(None).cast("long").alias("pb"), zero.alias("words"), (F.col("len") == 0).alias("is_end"))
    return nodes.unionByName(root)


def lines(path: DataFrame, step: int, height: int) -> DataFrame:
    """(a, b, up, own) of every node whose depth is a multiple of ``step``.

    ``up``: its ancestors in its band of ``height`` steps, itself included; if
    ``own`` is false, the node is the next band's top and ``up`` its ancestors in
    the band before. Blocks of a conversation hold at most ``height`` + 1 nodes.
    """
    at = path.filter(F.col("pos") % step == 0).select("conv_id", "pos", *NODE)
    band = F.floor(F.col("pos") / (step * height))
    top = (F.col("pos") % (step * height) == 0) & (F.col("pos") > 0)
    blocks = (at.withColumn("band", F.explode(F.when(top, F.array(band, band - 1)).otherwise(F.array(band))))
              .groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("pos", *NODE))).alias("line")))
    each = blocks.select("line", F.posexplode("line").alias("i", "n"))
    own = F.floor(F.col("n.pos") / (step * height)) == F.floor(F.col("line")[0]["pos"] / (step * height))
    got = each.select(F.col("n.a").alias("a"), F.col("n.b").alias("b"), own.alias("own"),
                      F.transform(F.slice("line", F.lit(1), F.col("i") + own.cast("int")),
                                  lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))).alias("up"))
    # every conversation through a node has the same line to it
    return got.groupBy(*NODE, "own").agg(F.first("up").alias("up"))


def rolled(path: DataFrame, values: DataFrame, deepest: int, height: int = HEIGHT, step: int = 1) -> DataFrame:
    """(a, b, v1, v2): the sums of ``values`` (a, b, v1, v2) over every node's subtree.

    ``values`` has the nodes whose depth is a multiple of ``step``; ``deepest``
    is the largest depth of all nodes.
    """
    line = C.stored(lines(path, step, height), "trie-lines")
    sums = [F.sum("v1").alias("v1"), F.sum("v2").alias("v2")]

    def added(to: DataFrame, what: DataFrame) -> DataFrame:
        return (to.join(what, list(NODE)).select(F.explode("up").alias("u"), "v1", "v2")
                .select("u.a", "u.b", "v1", "v2").groupBy(*NODE).agg(*sums))

    band = added(line.filter("own"), values)
    if deepest < step * height:
        return band
    band = C.stored(band, "trie-band")
    tops = path.filter(F.col("pos") % (step * height) == 0).select(*NODE).distinct()
    over = rolled(path, band.join(tops, list(NODE), "left_semi"), deepest, height, step * height)
    return band.unionByName(added(line.filter("not own"), over)).groupBy(*NODE).agg(*sums)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from the (a, b, conv_id) of the conversations that end at each node."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, bb, ids = (b.column(i).to_pylist() for i in range(3))
            at = 0
            rows = []
            while at < len(ids):
                to = at + 1
                while to < len(ids) and a[to] == a[at] and bb[to] == bb[at] and to - at < PIECE:
                    to += 1
                rows.append((a[at], bb[at], ids[at], ",".join(map(str, ids[at:to]))))
                at = to
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            out = []
            for x, y, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                if (x, y) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (x, y), hashlib.sha256(s.encode())
                else:
                    sha.update(b"," + s.encode())
            yield batch(out)
        if key is not None:
            yield batch([(*key, sha.hexdigest())])

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "ends_sha256"])

    joined = (ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
              .mapInArrow(pieces, "a long, b long, first long, ids string"))
    return (joined.repartition("a", "b").sortWithinPartitions("a", "b", "first")
            .mapInArrow(hashed, "a long, b long, ends_sha256 string"))


def trie(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the rebuilt conversations' prefix trie (turns: conv_id, turn, role, text)."""
    path = C.stored(rebuilt(turns), "trie-nodes")
    nodes = C.stored(path.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.count("*").alias("n_convs"), F.min("words").alias("words")), "trie-distinct")
    children = C.stored(nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
                        .agg(F.count("*").alias("n_children")), "trie-children")
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    known = nodes.join(children, list(NODE), "left").withColumn("n_children", n_children)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    values = known.select(*NODE, (F.col("n_children") == 0).cast("long").alias("v1"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("v2"))
    totals = rolled(path, values, deepest, height).select(*NODE, F.col("v1").alias("n_leaves"), F.col("v2").alias("saved_tokens"))
    ends = end_hashes(path.filter("is_end").select(*NODE, "conv_id"))
    # a parent with many children: its children are dealt by a salt, its row goes to each part
    busy = C.stored(children.filter(F.col("n_children") > SPLIT).select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.ceil(F.col("n_children") / SPLIT).cast("int").alias("pieces")), "trie-busy")
    salted = known.join(C.small_side(busy), ["pa", "pb"], "left").withColumn(
        "salt", F.pmod(F.xxhash64(*NODE), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces")
    parents = nodes.join(children, list(NODE)).select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"),
        F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n_children") / SPLIT) - 1).cast("int"))).alias("salt"))
    return (salted.join(parents, ["pa", "pb", "salt"], "left").join(totals, list(NODE)).join(ends, list(NODE), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie(C.read(spark, base, "conversations"))


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS family,
    -- crc32 of the decimal id: a byte is xored in, then eight shifts
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
head AS (SELECT c.conv_id, t.r AS pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.family AND t.r <= c.h),
heads AS (SELECT conv_id, count(*) AS m FROM head GROUP BY conv_id),
path AS (
  SELECT * FROM head
  UNION ALL
  SELECT t.conv_id, t.r - c.h + coalesce(m, 0), t.role, t.text
  FROM turns t JOIN convs c USING (conv_id) LEFT JOIN heads USING (conv_id) WHERE t.r > c.h),
named AS (
  SELECT conv_id, pos AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(md5(length(role)::VARCHAR || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS node
  FROM path),
rows AS (
  SELECT conv_id, depth, words, node, left(node, length(node) - 32) AS parent FROM named
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
ends AS (SELECT conv_id, arg_max(node, depth) AS node FROM rows GROUP BY conv_id),
hashes AS (SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM ends GROUP BY node),
nodes AS (SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth,
                 count(*) AS n_convs, any_value(words) AS words FROM rows GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
pairs AS (SELECT DISTINCT u.node AS node, d.node AS below FROM rows u JOIN rows d ON u.conv_id = d.conv_id AND u.depth <= d.depth),
totals AS (
  SELECT p.node, sum(CASE WHEN c.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM pairs p JOIN nodes n ON n.node = p.below LEFT JOIN children c ON c.node = p.below GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, coalesce(h.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON c.node = n.node
JOIN totals t ON t.node = n.node LEFT JOIN hashes h ON h.node = n.node
"""
