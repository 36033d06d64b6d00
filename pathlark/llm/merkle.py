"""A Merkle manifest of a table: a digest for each row, a root for each group and one for all, and proofs.

Leaves of a group ascend by id; runs of ``fan`` neighbours become a node, level by level, until one is left.
The nodes of a level stand on the rows of their first leaves, so that the next node of the level is a fixed
number of rows ahead: lag and lead columns with that offset, masked by the slot in the run and the run's
length, supply the siblings, and rows of first children hash their parents.

A window never holds a whole group: blocks of ``fan ** levels`` leaves are windows of their own, which no run
crosses. The blocks' roots are the leaves of the next tier, and so on; the groups' roots are one more group.
On the way down each row's path within its block is followed by the path of its block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathlark.llm.common import read_table
from pathlark.llm.order import numbered
from pathlark.session import stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN, LEVELS = 2, 10
#: The query's tampering: rows whose id has a checksum that this divides.
TAMPERED = 7


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length before it, so that no two rows run into the same text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[str], **changed: Column) -> Column:
    return digest(*(field(changed.get(c, F.col(c))) for c in columns))


def _tier(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """``block``; ``path``: the siblings (left, right) of each level up to the block's root; ``top``: that root."""
    size = fan**levels
    own = Window.partitionBy("grp", "block").orderBy("pos")
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumn("block", F.expr(f"pos div {size}L")).withColumn("h0", F.col("hash"))
    steps = []
    for k in range(levels):
        step, h = fan**k, F.col(f"h{k}")
        first = F.col("pos") % step == 0
        slot = F.expr(f"pos div {step}L") % fan
        count = F.expr(f"(total + {step - 1}L) div {step}L")
        run = F.least(F.lit(fan), count - F.expr(f"pos div {step}L") + slot)
        rows = rows.select("*", *(F.lag(h, o * step).over(own).alias(f"l{o}") for o in range(1, fan)),
                           *(F.lead(h, o * step).over(own).alias(f"r{o}") for o in range(1, fan)))
        left = F.concat_ws("", *(F.when(slot >= o, F.col(f"l{o}")) for o in range(fan - 1, 0, -1)))
        right = F.concat_ws("", *(F.when(slot + o < run, F.col(f"r{o}")) for o in range(1, fan)))
        rows = rows.withColumn(f"a{k}", F.when(first, left)).withColumn(f"b{k}", F.when(first, right))
        parent = F.when(first & (slot == 0), digest(h, F.col(f"b{k}")))
        rows = rows.withColumn(f"h{k + 1}", F.when(count > 1, parent).otherwise(h)).drop(
            *(f"{side}{o}" for side in "lr" for o in range(1, fan)))
        # a leaf's node of this level stands on the last first row before it
        steps.append(F.when(count > 1, F.struct(
            F.last(f"a{k}", True).over(so_far).alias("left"), F.last(f"b{k}", True).over(so_far).alias("right"))))
    path = F.filter(F.array(*steps), lambda x: x.isNotNull())
    return rows.select(*nodes.columns, "block", path.alias("path"), F.last(f"h{levels}", True).over(so_far).alias("top"))


def _raised(nodes: DataFrame, fan: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers from the leaves up, and the root of each group."""
    tiers = []
    largest = nodes.agg(F.max("total")).first()[0] or 0
    while True:
        height = next((k for k in range(levels) if fan**k >= largest), levels)  # no level that no group has
        size = fan**height
        tiers.append(_tier(nodes, fan, height))
        nodes = stored(tiers[-1].filter(F.col("pos") % size == 0).select(
            "grp", F.col("block").alias("pos"), F.expr(f"(total + {size - 1}L) div {size}L").alias("total"), F.col("top").alias("hash")), "nodes")
        largest = -(-largest // size)
        if largest <= 1:
            return tiers, nodes


def _lowered(tiers: list[DataFrame], roots: DataFrame) -> DataFrame:
    """Rows of the lowest tier with the path up to the last root. ``roots``: grp, rest, subroot, root."""
    above = roots.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        rows = tier.join(above, ["grp", "block"]).withColumn("path", F.concat("path", "rest")).drop("rest", "block", "top")
        above = rows.select("grp", F.col("pos").alias("block"), F.col("path").alias("rest"), "subroot", "root")
    return rows


def manifest(leaves: DataFrame, order: list, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Adds ``subroot``, ``root`` and ``path`` to leaves: any columns, with ``grp`` (string) and ``hash``.

    Groups are ordered bytewise, null first. The path is an array of (left, right), the digests before and
    behind the own node in its run, from the leaf's level to the root's: ``folded(hash, path)`` is the root.
    An empty table stays empty. Leaves equal in ``order`` are ordered by their digest, so equal rows have
    places of their own, any of which gives the same manifest.
    """
    kept = leaves.columns
    # null first, and a text for it that no group has
    known = leaves.withColumn("_grp", F.col("grp")).withColumn("grp", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("")))
    nodes = numbered(known, "grp", [*order, F.col("hash")], "leaves")
    tiers, subroots = _raised(nodes, fan, levels)
    groups = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), "hash")
    upper, root = _raised(numbered(groups, "grp", [F.col("own")], "groups"), fan, levels)
    tops = _lowered(upper, root.select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("rest"),
                                       F.col("hash").alias("subroot"), F.col("hash").alias("root")))
    tops = stored(tops.select(F.col("own").alias("grp"), F.col("path").alias("rest"), F.col("hash").alias("subroot"), "root"), "tops")
    rows = _lowered(tiers, tops)
    return rows.withColumn("grp", F.col("_grp")).select(*kept, "subroot", "root", "path")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, start, lambda acc, x: digest(x["left"], acc, x["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null ids come first in their group and are not tampered with; equal ids are ordered by their leaf."""
    docs = read_table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    leaves = docs.select("doc_id", F.col("lang").cast("string").alias("grp"), leaf(FIELDS).alias("hash"),
                         F.when(hit, leaf(FIELDS, n_chars=more)).alias("tampered"))
    rows = manifest(stored(leaves, "digests"), [F.col("doc_id")])
    rows = rows.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       folded(F.coalesce("tampered", "hash"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Bitwise checksum, as there is none in this SQL.
CRC32 = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT),
    lambda a, c: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, c)), 4294967295::BIGINT))"""
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS) + ")"
ORACLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS grp, {_LEAF} AS leaf,
        CASE WHEN {CRC32.format("doc_id::VARCHAR")} % {TAMPERED} = 0 THEN {_LEAF.replace("n_chars::", "(n_chars + 1)::")} END AS tampered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), up AS (
    SELECT grp, 0 AS lvl, pos, leaf AS hash FROM placed
    UNION ALL
    SELECT grp, lvl + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM up) WHERE n > 1 GROUP BY grp, lvl, pos // 2
), subroots AS (
    SELECT grp, hash AS subroot, lvl AS levels, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos
    FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY lvl DESC) AS k FROM up) WHERE k = 1
), top AS (
    SELECT 0 AS lvl, pos, subroot AS hash FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lvl, pos // 2
), steps AS (
    SELECT p.grp, p.pos, u.lvl, u.pos AS node, s.hash AS sibling
    FROM placed p JOIN subroots r ON r.grp = p.grp
    JOIN up u ON u.grp = p.grp AND u.pos = p.pos >> u.lvl AND u.lvl < r.levels
    LEFT JOIN up s ON s.grp = u.grp AND s.lvl = u.lvl AND s.pos = xor(u.pos, 1)
    UNION ALL
    SELECT p.grp, p.pos, r.levels + u.lvl, u.pos, s.hash
    FROM placed p JOIN subroots r ON r.grp = p.grp
    JOIN top u ON u.pos = r.pos >> u.lvl AND u.lvl < (SELECT max(lvl) FROM top)
    LEFT JOIN top s ON s.lvl = u.lvl AND s.pos = xor(u.pos, 1)
), fold AS (
    SELECT grp, pos, 0 AS lvl, coalesce(tampered, leaf) AS acc FROM placed
    UNION ALL
    SELECT f.grp, f.pos, f.lvl + 1, sha256(CASE WHEN s.node % 2 = 1 THEN coalesce(s.sibling, '') ELSE '' END || f.acc
        || CASE WHEN s.node % 2 = 0 THEN coalesce(s.sibling, '') ELSE '' END)
    FROM fold f JOIN steps s ON s.grp = f.grp AND s.pos = f.pos AND s.lvl = f.lvl
), ends AS (
    SELECT grp, pos, max_by(acc, lvl) AS folded_root FROM fold GROUP BY grp, pos
), proofs AS (
    SELECT grp, pos, string_agg(coalesce(sibling, ''), '' ORDER BY lvl) AS proof FROM steps GROUP BY grp, pos
), root AS (SELECT max_by(hash, lvl) AS root FROM top)
SELECT p.doc_id, p.leaf, r.subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots r ON r.grp = p.grp JOIN ends e ON e.grp = p.grp AND e.pos = p.pos
LEFT JOIN proofs x ON x.grp = p.grp AND x.pos = p.pos, root
"""
