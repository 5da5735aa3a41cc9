"""A Merkle manifest of a dataset, its nodes labelled by the leaf ranks they cover.

Leaves of a source are ranked by doc_id.  A node at level ``l`` covers the interval
``[lo, hi)`` of at most 3**l ranks.  A leaf's ancestors are the nodes whose intervals contain
its own; its siblings at a level are the parts of the parent's interval that do not.  Levels
are handled ``TIER`` at a time in buckets of 3**TIER neighbours: a bucket's nodes are built
and joined to what they contain inside the bucket, so no task ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ordered import running_totals
from eventloom.functions.storage import materialise
from eventloom.llm.base import documents

ARITY = 3
#: Levels joined at a time; a bucket has 3**TIER nodes at its lowest level and 40 above.
TIER = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: No table has as many rows as the last of these.
_POWERS = [ARITY**i for i in range(39)]

_CHILD = "struct<lo:bigint,hi:bigint,digest:string>"
_NODE = f"struct<level:int,lo:bigint,hi:bigint,children:array<{_CHILD}>>"


def record_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 of a row: each value as its length in bytes, a colon and itself; ``-`` if null."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, tampered``: the last is null where nothing is altered."""
    fields = {c: F.col(c) for c in FIELDS}
    altered = fields | {"text": F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))}
    even = F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "UTF-8")) % 2 == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        record_digest(fields).alias("leaf"),
        F.when(even & F.contains(F.col("text").cast("string"), F.lit("\n")), record_digest(altered)).alias("tampered"),
    )


def _ranked(leaves: DataFrame, by: list[str], order: list[str], digest: str) -> DataFrame:
    """Leaves of one tree per key: interval, digest and the tree's height."""
    placed = running_totals(leaves.withColumn("_one", F.lit(1)), by, order, {"_rank": "_one"})
    powers = F.array(*[F.lit(p).cast("long") for p in _POWERS])
    size = F.col("_rank_all")
    return placed.select(
        (F.struct(*by) if by else F.struct(F.lit(0).alias("all"))).alias("key"),
        F.size(F.filter(powers, lambda p: p < size)).alias("height"),
        (F.col("_rank") - 1).alias("lo"),
        F.col("_rank").alias("hi"),
        F.col(digest).alias("digest"),
        F.struct(*[c for c in leaves.columns]).alias("row"),
    )


def _part(span: int) -> Column:
    """Which run of ``span`` ranks a node starts in."""
    return F.expr(f"lo div {span}L")


def _built(base: DataFrame, tier: int) -> DataFrame:
    """One row a bucket: its top node, and all nodes above its base with their children.

    A tree that has a single node left is passed on unchanged.
    """
    rows = (
        base.select("key", "height", _part(ARITY ** (TIER * (tier + 1))).alias("bucket"), "lo", "hi", "digest")
        .repartition("key", "bucket")
        .withColumn("nodes", F.array().cast(f"array<{_NODE}>"))
    )
    for level in range(TIER * tier + 1, TIER * (tier + 1) + 1):
        runs = rows.groupBy("key", "height", "bucket", _part(ARITY**level).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),
            F.flatten(F.collect_list("nodes")).alias("nodes"),
        )
        first, last = F.col("children")[0], F.element_at("children", -1)
        merged = F.lit(level) <= F.col("height")
        node = F.struct(F.lit(level).alias("level"), first["lo"].alias("lo"), last["hi"].alias("hi"), F.col("children"))
        rows = runs.select(
            "key",
            "height",
            "bucket",
            first["lo"].alias("lo"),
            last["hi"].alias("hi"),
            F.when(merged, F.sha2(F.array_join("children.digest", ""), 256)).otherwise(first["digest"]).alias("digest"),
            F.when(merged, F.concat("nodes", F.array(node))).otherwise(F.col("nodes")).cast(f"array<{_NODE}>").alias("nodes"),
        )
    return materialise(rows, f"tier-{tier}")


class Forest:
    """The trees over ranked leaves, written tier by tier."""

    def __init__(self, ranked: DataFrame):
        self.base = [ranked]
        self.tiers: list[DataFrame] = []
        highest = ranked.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
        for tier in range(max(1, -(-highest // TIER))):
            self.tiers.append(_built(self.base[tier], tier))
            above = self.tiers[tier].where(F.col("height") > TIER * (tier + 1))
            self.base.append(above.select("key", "height", "lo", "hi", "digest"))

    def _ends_in(self, tier: int) -> Column:
        return F.col("height") <= TIER * (tier + 1)

    def roots(self) -> DataFrame:
        """``key, digest`` of each tree."""
        tops = [t.where(self._ends_in(i)).select("key", "digest") for i, t in enumerate(self.tiers)]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out

    def with_paths(self, above: DataFrame, carried: str) -> DataFrame:
        """The leaves with ``path``, their siblings level by level, then those of ``above``.

        ``above`` has ``key, path`` and a struct ``carried`` of each tree's root.
        """
        over = above.withColumn("bucket", F.lit(0).cast("long"))
        for tier in reversed(range(len(self.tiers))):
            # Nodes of higher tiers pass their path on; trees that end here take their root's.
            built = self.tiers[tier]
            ending = built.where(self._ends_in(tier)).select("key").join(above, "key")
            tops = ending.select("key", F.lit(0).cast("long").alias("bucket"), "path", carried)
            if tier < len(self.tiers) - 1:
                tops = tops.unionByName(over.select("key", "bucket", "path", carried))
            nodes = built.select("key", "bucket", F.explode("nodes").alias("node"))
            attached = self._attached(self.base[tier], nodes, tier)
            joined = attached.join(tops, ["key", "bucket"]).withColumn("path", F.concat("own", "path"))
            if tier == 0:
                return joined
            span = ARITY ** (TIER * tier)
            over = materialise(
                joined.select("key", _part(span).alias("bucket"), "path", carried), f"paths-{tier}"
            )
        raise AssertionError("a forest has at least one tier")

    def _attached(self, base: DataFrame, nodes: DataFrame, tier: int) -> DataFrame:
        """Containment join within buckets, and the siblings that the intervals tell."""
        columns = [c for c in base.columns if c != "digest"]
        low = base.withColumn("bucket", _part(ARITY ** (TIER * (tier + 1)))).repartition("key", "bucket")
        high = nodes.repartition("key", "bucket").withColumnsRenamed({"key": "n_key", "bucket": "n_bucket"})
        inside = (
            (F.col("key") == F.col("n_key"))
            & (F.col("bucket") == F.col("n_bucket"))
            & (F.col("node.lo") <= F.col("lo"))
            & (F.col("hi") <= F.col("node.hi"))
        )

        def beside(test) -> Column:
            return F.array_join(F.transform(F.filter(F.col("node.children"), test), lambda c: c["digest"]), "")

        step = F.struct(
            F.col("node.level").alias("level"),
            beside(lambda c: c["hi"] <= F.col("lo")).alias("left"),
            beside(lambda c: c["lo"] >= F.col("hi")).alias("right"),
        )
        return (
            low.join(high, inside, "left")
            .groupBy(*columns, "bucket")
            .agg(F.sort_array(F.collect_list(F.when(F.col("node").isNotNull(), step))).alias("own"))
        )


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, its source's root, the root of all, and its proof.

    Nulls are ``-`` in the digest.  Within a source a null doc_id comes first, repeated ids go
    by their leaves, and identical rows keep a leaf each.  A null doc_id is never tampered
    with.  A null source is a source of its own, before the others.  Texts are hashed whole.
    An empty table gives an empty result; further columns are ignored.
    """
    forest = Forest(_ranked(_leaves(docs), ["source"], ["doc_id", "leaf"], "leaf"))
    subroots = materialise(forest.roots(), "subroots")
    crown = Forest(_ranked(subroots.select("key.source", "digest"), [], ["source"], "digest"))
    root = crown.roots().select("digest").first()
    top = crown.roots().select(
        "key", F.array().cast("array<struct<level:int,left:string,right:string>>").alias("path"), F.struct("digest").alias("end")
    )
    above = crown.with_paths(top, "end").select(
        F.struct(F.col("row.source").alias("source")).alias("key"),
        "path",
        F.struct(F.col("row.digest").alias("subroot"), F.col("end.digest").alias("root")).alias("ends"),
    )
    rows = forest.with_paths(materialise(above, "subroot-paths"), "ends")
    folded = F.aggregate(
        "path",
        F.coalesce("row.tampered", "row.leaf"),
        lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256),
    )
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    proved = rows.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.leaf").alias("leaf"),
        F.col("ends.subroot").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))


def _tree(name: str, leaves: str, key: str) -> str:
    return f"""{name}({key}, level, pos, h, n) AS (
  SELECT {key}, 0, pos, h, n FROM {leaves}
  UNION ALL
  SELECT {key}, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY {key}, level, pos // 3, n
)"""


_VALUE = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_DIGEST = "sha256(" + " || ".join(_VALUE.format(c) for c in FIELDS[:-1]) + " || {0})"

# A doc_id's CRC-32 is computed from the table of all bytes; only its last bit is needed.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY n) AS step FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS n))
), hashed AS (
  SELECT doc_id, source, {_DIGEST.format(_VALUE.format("text"))} AS leaf,
         {_DIGEST.format(_VALUE.format("replace(text, chr(10), '')"))} AS altered,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
                                                                 lambda x: CAST('0x' || x AS BIGINT))),
                         lambda c, x: xor(c >> 8, step[xor(c & 255, x) + 1])), 4294967295) AS crc
  FROM documents, crc
), ranked AS (
  SELECT *, row_number() OVER w - 1 AS pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n
  FROM hashed WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
), {_tree("tree", "ranked", "source")}, subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, 1 AS one
  FROM tree WHERE n = 1
), {_tree("crown", "subroots", "one")}, steps AS (
  SELECT d.doc_id, d.source, d.pos, 0 AS part, t.level,
         string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < t.pos) AS l, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > t.pos) AS r
  FROM ranked d
  JOIN tree t ON t.source IS NOT DISTINCT FROM d.source AND t.pos = d.pos // CAST(pow(3, t.level) AS BIGINT) AND t.n > 1
  JOIN tree s ON s.source IS NOT DISTINCT FROM d.source AND s.level = t.level AND s.pos // 3 = t.pos // 3
  GROUP BY d.doc_id, d.source, d.pos, t.level
  UNION ALL
  SELECT d.doc_id, d.source, d.pos, 1, t.level,
         string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < t.pos), string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > t.pos)
  FROM ranked d
  JOIN subroots u ON u.source IS NOT DISTINCT FROM d.source
  JOIN crown t ON t.pos = u.pos // CAST(pow(3, t.level) AS BIGINT) AND t.n > 1
  JOIN crown s ON s.level = t.level AND s.pos // 3 = t.pos // 3
  GROUP BY d.doc_id, d.source, d.pos, t.level
), paths AS (
  SELECT source, pos, string_agg(coalesce(l, '') || coalesce(r, ''), '' ORDER BY part, level) AS proof,
         list(coalesce(l, '') || '|' || coalesce(r, '') ORDER BY part, level) AS path
  FROM steps GROUP BY source, pos
), folded AS (
  SELECT d.doc_id, d.leaf, u.h AS subroot, (SELECT h FROM crown WHERE n = 1) AS root,
         sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(CASE WHEN crc % 2 = 0 THEN altered ELSE leaf END, coalesce(p.path, [])),
                     lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
  FROM ranked d JOIN subroots u ON u.source IS NOT DISTINCT FROM d.source
  LEFT JOIN paths p ON p.source IS NOT DISTINCT FROM d.source AND p.pos = d.pos
)
SELECT *, folded_root = root AS verified FROM folded
"""
