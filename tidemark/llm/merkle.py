"""A Merkle manifest of a table of documents, kept as node rows that name their parents; proofs by a recursive query.

Per language, leaves stand in the order of their ids, and every eight nodes in a row become one; what remains of each language is
a subroot, and subroots become the root likewise. Each level is one aggregate over runs of eight and is stored. A node's row holds
its parent, its digest and the digests of its siblings, so that a recursive query climbs from leaves to the root by one join a level:
it appends the siblings to the proof and folds each leaf's hash with them. The leaves of one run have all siblings above it in common
and climb as one row, in which each leaf has a hash of its own.

The climb has two recursive queries. Below, where no node has more than a small share of the leaves, nodes are joined by a shuffle
without hot keys; above, there are few nodes, and they are broadcast: ``SHARE`` at most for each level.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.common import saved, share_code, table

#: Nodes of a run.
RUN = 8
#: A node above this fraction of all leaves is broadcast: there are fewer than this on a level.
SHARE = 1024
#: Chunks of a table's order, or languages, that are broadcast at most.
BROADCAST_ROWS = 200_000
#: The tree over subroots; those of languages have their numbers.
TOP = -1
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def written(value: Column) -> Column:
    """A value as a leaf's hash takes it: ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**changed: Column) -> Column:
    """SHA-256 of a document's fields, as bytes."""
    return F.unhex(F.sha2(F.concat(*[written(changed.get(c, F.col(c))) for c in FIELDS]), 256))


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaves(docs: DataFrame, modulus: int = 3) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf``, and ``changed``: the hash after tampering where ``modulus`` divides the id's CRC-32, else null.

    Tampering lower-cases the text's A-Z. Rows without an id are not tampered with.
    """
    share_code(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang")], F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return rows.select("doc_id", "lang", leaf_hash().alias("leaf"), F.when(picked, leaf_hash(text=lower)).alias("changed"))


def places(rows: DataFrame, group: str | None, *order: str) -> DataFrame:
    """``rows`` with ``place``: from 0 in each group, in the order named, nulls first; equal rows are in any order.

    Rows are dealt in ranges, so that no group is in one task; what earlier chunks hold of a group is added to a row's place in its chunk.
    """
    by = [*([group] if group else []), *order]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by, "_row").sortWithinPartitions(*by, "_row")
    numbered = saved(dealt.drop("_row").withColumn("_at", F.monotonically_increasing_id()).withColumn("_chunk", F.shiftright("_at", 33)))
    of = F.col(group) if group else F.lit(0)
    sizes = numbered.groupBy("_chunk", of.alias("_of")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # At most one row for each chunk and one for each group; of a group, one for each of its chunks.
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy("_of").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = saved(before.select(F.col("_chunk").alias("_c"), "_of", "_first", "_before"))
    few = F.broadcast(before) if before.count() <= BROADCAST_ROWS else before
    placed = numbered.join(few, (F.col("_chunk") == F.col("_c")) & of.eqNullSafe(F.col("_of")))
    return placed.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"))


def node(tree: Column, level: Column, at: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """Runs of ``nodes`` (``tree``, ``at``, ``under``, ``child``: a struct with ``at``, ``digest``): one row for each parent."""
    made = nodes.groupBy("tree", F.expr(f"at div {RUN}").alias("at")).agg(
        F.sort_array(F.collect_list("child")).alias("children"), F.sum("under").alias("under")
    )  # of eight rows at most
    joined = F.array_join(F.transform("children", lambda c: hex_of(c.digest)), "")
    return made.select("tree", F.lit(level).alias("level"), "at", "children", "under", F.unhex(F.sha2(joined, 256)).alias("digest"))


class Manifest(NamedTuple):
    """``runs``: of leaves, with their parents' nodes; ``links``: nodes above leaves, with parents and siblings; ``subroots``: by language."""

    runs: DataFrame
    links: DataFrame | None
    subroots: DataFrame
    root: bytes
    total: int


def _beside(children: Column, at: Column, side: str) -> Column:
    """Digests of the siblings before or after the one at ``at``, end to end."""
    some = F.filter(children, lambda c: (c.at < at) if side == "before" else (c.at > at))
    return F.aggregate(some, F.expr("X''"), lambda all_, c: F.concat(all_, c.digest))


def _links(runs: DataFrame) -> DataFrame:
    """A row for each child of ``runs``; ``own`` counts its leaves, ``under`` its parent's."""
    opened = runs.select(node(F.col("tree"), F.col("level"), F.col("at")).alias("parent"), "children", "under", F.explode("children").alias("child"))
    return opened.select(
        F.col("child.node").alias("node"), "parent", F.col("child.digest").alias("digest"), _beside(F.col("children"), F.col("child.at"), "before").alias("before"),
        _beside(F.col("children"), F.col("child.at"), "after").alias("after"), F.col("child.under").alias("own"), "under",
    )


def build(docs: DataFrame, modulus: int = 3) -> Manifest | None:
    """The manifest of ``docs`` (``doc_id``, ``source``, ``lang``, ``n_chars``, ``text``; others are left out); None of an empty table.

    Rows without an id are the first of their language; of equal ids, the lesser digest comes first. A null language is one of its own.
    """
    found = saved(leaves(docs, modulus))
    langs = saved(places(saved(found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))), None, "lang").select(F.col("lang").alias("_lang"), F.col("place").alias("tree"), "n"))
    many, total, largest = langs.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    if not many:
        return None
    few = F.broadcast(langs) if many <= BROADCAST_ROWS else langs
    placed = places(found, "lang", "doc_id", "leaf").join(few, F.col("lang").eqNullSafe(F.col("_lang")))
    rows = placed.select("tree", F.col("place").alias("at"), F.lit(1).cast("long").alias("under"), F.struct(F.col("place").alias("at"), F.col("leaf").alias("digest"), "doc_id", "changed").alias("child"))
    # A language of one document has no run: its leaf is the subroot, and climbs by itself.
    made = _runs(rows, 1).join(few.select("tree", "n"), "tree")
    alone = F.col("n") == 1
    digest = F.when(alone, F.col("children")[0]["digest"]).otherwise(F.col("digest"))
    runs = saved(made.select("tree", F.when(alone, 0).otherwise(1).alias("level"), "at", "children", "under", digest.alias("digest")))
    as_child = F.struct("at", "digest", node(F.col("tree"), F.col("level"), F.col("at")).alias("node"), "under").alias("child")
    levels, level, width = [runs], 1, -(-largest // RUN)
    while width > 1:
        level, below = level + 1, levels[-1]
        # Languages that are down to one node stay as they are: theirs is the subroot.
        going = below.filter(F.col("level") == level - 1).join(few.filter(F.col("n") > RUN ** (level - 1)).select("tree"), "tree", "left_semi")
        levels.append(saved(_runs(going.select("tree", "at", "under", as_child), level)))
        width = -(-width // RUN)
    heads = levels[0].select("tree", "level", "at", "digest", "under")
    for more in levels[1:]:
        heads = heads.unionByName(more.select("tree", "level", "at", "digest", "under"))
    # A subroot has all leaves of its language beneath it, and is the highest such node.
    top_level = F.when(F.col("n") == 1, 0).otherwise(F.greatest(F.lit(1), F.expr(f"length(conv(n - 1, 10, {RUN}))")))
    subroots = saved(heads.join(few.select("tree", "n", "_lang"), "tree").filter((F.col("level") == top_level) & (F.col("at") == 0)).select("tree", F.col("_lang").alias("lang"), "level", "digest", "under"))
    links = [_links(x) for x in levels[1:]]
    if many > 1:
        level += 1
        now = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), "under", F.struct(F.col("tree").alias("at"), "digest", node(F.col("tree"), F.col("level"), F.lit(0)).alias("node"), "under").alias("child"))
        width = many
        while width > 1:
            above = saved(_runs(now, level))
            links.append(_links(above))
            now, level, width = above.select("tree", "at", "under", as_child), level + 1, -(-width // RUN)
        root = above.select("digest").first()[0]
    else:
        root = subroots.select("digest").first()[0]
    every = None
    for more in links:
        every = more if every is None else every.unionByName(more)
    return Manifest(runs, saved(every) if every is not None else None, subroots, bytes(root), total)


#: One level: from a row's node to its parent, whose leaves are ``under``.
CLIMB = f"""
WITH RECURSIVE climb(node, under, hashes, leaves, proof, subroot) AS (
  SELECT node, under, hashes, leaves, proof, subroot FROM {{start}}
  UNION ALL
  SELECT {{hint}} n.parent, n.under,
         transform(c.hashes, h -> unhex(sha2(concat(lower(hex(n.before)), lower(hex(h)), lower(hex(n.after))), 256))), c.leaves,
         concat(c.proof, n.before, n.after), CASE WHEN n.parent.tree = {TOP} AND n.node.tree <> {TOP} THEN n.digest ELSE c.subroot END
  FROM climb AS c JOIN {{links}} AS n ON c.node = n.node
)
SELECT * FROM climb"""


def _ascend(start: DataFrame, links: DataFrame, hint: str = "") -> DataFrame:
    """All that the recursive query passes. Its limit of rows, which is a guard against endless queries, is off while it runs."""
    spark = start.sparkSession
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return saved(spark.sql(CLIMB.replace("{hint}", hint), start=start, links=links))
    finally:
        spark.conf.set(ROW_LIMIT, limit)


def prove(manifest: Manifest) -> DataFrame:
    """Per document: ``doc_id``, ``leaf``, ``subroot``, ``root`` (bytes), ``proof`` (its siblings' digests end to end, from below), and ``folded_root``.

    The last is what the tampered hash, if there is one, or else the leaf, gives with those siblings.
    """
    total = manifest.total
    folded = F.transform(
        "children",
        lambda me: F.when(F.col("level") == 0, F.coalesce(me.changed, me.digest)).otherwise(
            F.unhex(
                F.sha2(
                    F.concat(hex_of(_beside(F.col("children"), me.at, "before")), hex_of(F.coalesce(me.changed, me.digest)), hex_of(_beside(F.col("children"), me.at, "after"))), 256
                )
            )
        ),
    )
    plain = F.transform("children", lambda c: F.struct(c.doc_id.alias("doc_id"), c.digest.alias("digest")))
    now = manifest.runs.select(node(F.col("tree"), F.col("level"), F.col("at")).alias("node"), "under", folded.alias("hashes"), plain.alias("leaves"), F.expr("X''").alias("proof"), F.lit(None).cast("binary").alias("subroot"))
    if manifest.links is not None:
        # A node's share of the leaves only grows on the way up: the broadcast part begins where it passes the limit.
        few = saved(manifest.links.filter(F.col("own") * SHARE > total))
        low = manifest.links.filter(F.col("own") * SHARE <= total)
        start = saved(now)
        high = F.col("under") * SHARE > total
        below = _ascend(start.filter(~high), low).filter(high)
        now = _ascend(saved(start.filter(high).unionByName(below)), few, "/*+ BROADCAST(n) */").filter(F.col("under") == total)
    at = now.select(F.posexplode("leaves").alias("at", "leaf"), "hashes", "leaves", "proof", "subroot")
    beside = F.expr("aggregate(filter(leaves, (x, k) -> k <> at), X'', (all, x) -> concat(all, x.digest))")
    root = F.unhex(F.lit(manifest.root.hex()))
    return at.select(
        F.col("leaf.doc_id").alias("doc_id"), F.col("leaf.digest").alias("leaf"), F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.concat(beside, F.col("proof")).alias("proof"), F.expr("hashes[at]").alias("folded_root"),
    )


PROVED = "doc_id long, leaf binary, subroot binary, root binary, proof binary, folded_root binary"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = build(table(spark, sf_dir, "documents"))
    proved = prove(manifest) if manifest else spark.createDataFrame([], PROVED)
    named = [hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return proved.select("doc_id", *named, F.sha2(hex_of(F.col("proof")), 256).alias("proof_sha256"), hex_of(F.col("folded_root")).alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


SQL = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
  SELECT *, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS digest,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') END) AS changed,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS crc,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS spot, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM (SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
               || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head
        FROM documents)
), nodes AS (
  SELECT tree, 0 AS level, spot, digest FROM leaf
  UNION ALL
  SELECT tree, level + 1, spot // {RUN}, sha256(string_agg(digest, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, spot // {RUN}
), subroots AS MATERIALIZED (
  SELECT tree, max_by(digest, level) AS digest FROM nodes GROUP BY tree
), tops AS (
  SELECT 0 AS level, tree AS spot, digest FROM subroots
  UNION ALL
  SELECT level + 1, spot // {RUN}, sha256(string_agg(digest, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, spot // {RUN}
), links AS MATERIALIZED (
  SELECT *, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT *, count(*) OVER (PARTITION BY tree, level) AS n FROM (SELECT * FROM nodes UNION ALL SELECT {TOP}, level, spot, digest FROM tops)) WHERE n > 1
  WINDOW run AS (PARTITION BY tree, level, spot // {RUN} ORDER BY spot)
), inside AS (
  SELECT doc_id, tree, 0 AS level, spot, CASE WHEN crc % 3 = 0 THEN changed ELSE digest END AS folded, '' AS proof FROM leaf
  UNION ALL
  SELECT doc_id, tree, c.level + 1, c.spot // {RUN}, sha256(before || folded || after), proof || before || after FROM inside AS c JOIN links AS l USING (tree, level, spot)
), above AS (
  SELECT doc_id, 0 AS level, tree AS spot, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM inside GROUP BY doc_id, tree
  UNION ALL
  SELECT doc_id, c.level + 1, c.spot // {RUN}, sha256(before || folded || after), proof || before || after FROM above AS c JOIN links AS l ON l.tree = {TOP} AND l.level = c.level AND l.spot = c.spot
), done AS (
  SELECT doc_id, arg_max(folded, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM above GROUP BY doc_id
), top AS (
  SELECT max_by(digest, level) AS root FROM tops
)
SELECT doc_id, leaf.digest AS leaf, subroots.digest AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaf JOIN subroots USING (tree) JOIN done USING (doc_id), top"""
