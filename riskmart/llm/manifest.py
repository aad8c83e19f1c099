"""Merkle manifest of a dataset, its upper proofs made by a butterfly exchange.

A row is a leaf: the digest of its fields.  The leaves of a group stand in key
order; every ``FANOUT`` consecutive nodes of a level become one node of the
next until one is left, the group's subroot; the subroots in group order are
the leaves of one more tree, whose top is the root.

1. Positions: rows are range-partitioned and sorted, their places written down,
   and the rows before a partition added from one count per partition and group.
   Equal rows are told apart by their place in the input, so a row copied into a
   third of the table is spread over partitions too.
2. Blocks: ``FANOUT ** HEIGHT`` consecutive leaves are one aligned block, one row
   of a table, which hashes its own subtree.
3. Butterfly: in round ``r`` the blocks whose numbers differ only in digit ``r``
   (base ``FANOUT``) swap the roots of their subtrees, and each of them hashes the
   common ancestor itself.  After as many rounds as a number has digits every
   block holds its whole upper proof; nothing comes down from the root.  A last
   subtree with fewer blocks than partners serves several of them in turn, so
   no block answers more than ``FANOUT`` partners of a complete subtree.
4. A block joins its proof and gives each of its leaves its path.

A path is a list of (before, after): the siblings left and right of the node,
level by level from the leaf to the root.  ``folded`` recomputes a root from it.

Cases: a null field is ``-`` and an empty text ``0:``, so they differ; a null
group is a group of its own, first in order; null keys stand first; rows with the
same key stand in the order of their digests, equal rows get equal results; a
group of one row is its own subroot, a single group its own root; an empty table
gives no rows.  Columns that are not hashed are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

FANOUT = 8
#: Levels inside a block: 8 ** 3 = 512 leaves.
HEIGHT = 3
#: What a leaf holds, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<before:string,after:string>>"


def leaf_digest(*values: Column) -> Column:
    """Digest of fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*map(field, values)), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``path`` leads to from ``leaf``."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _joined(a: DataFrame, b: DataFrame, *names: str) -> DataFrame:
    """Inner join on columns of the same names, nulls equal."""
    b = b.withColumnsRenamed({name: f"_{name}" for name in names})
    on = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]
    return a.join(b, on).drop(*[f"_{name}" for name in names])


def _placed(leaves: DataFrame) -> DataFrame:
    """(g, leaf, more) with ``pos``, the place in the group, and ``n``, the leaves of the group."""
    rows = stored(leaves.withColumn("tie", F.monotonically_increasing_id()), "manifest-leaves")
    order = ("g", "k", "leaf", "tie")
    # The id of a sorted row holds its partition and its place there; written down, both stay.
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("g", "leaf", "more", F.monotonically_increasing_id().alias("at"))
                  .withColumn("part", F.shiftright("at", 33)), "manifest-order")
    starts = rows.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("g", "part", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
                           F.sum("held").over(group).alias("n"))
    return _joined(rows, starts, "g", "part").select(
        "g", "n", "leaf", "more", (F.col("before") + F.col("at") - F.col("first")).alias("pos"))


def _above(level: Column, fanout: int) -> Column:
    """The next level of a list of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(level, i * fanout + 1, F.lit(fanout)), ""), 256))


def _with_levels(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """Adds ``level0`` .. ``level<height>``; levels above the top of a group's tree are null."""
    out = blocks.withColumn("level0", F.col("members.leaf"))
    for k in range(height):
        out = out.withColumn(f"level{k + 1}", F.when(F.col("n") > fanout ** k, _above(F.col(f"level{k}"), fanout)))
    return out


def _blocks(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """One row per aligned block: g, n, block, members (pos, leaf, more) in order, digest of its subtree."""
    block = F.floor(F.col("pos") / fanout ** height).alias("block")
    blocks = placed.groupBy("g", "n", block).agg(F.sort_array(F.collect_list(F.struct("pos", "leaf", "more"))).alias("members"))
    levels = _with_levels(blocks, fanout, height)
    top = F.coalesce(*[F.col(f"level{k}") for k in reversed(range(height + 1))])
    return stored(levels.select("g", "n", "block", "members", F.element_at(top, 1).alias("digest")), "manifest-blocks")


def _butterfly(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """(g, block, digest, path): every block with the top of its group's tree and its path there from its own root."""
    size = fanout ** height
    most = blocks.agg(F.max("n")).first()[0] or 0
    now = blocks.select("g", "block", F.ceil(F.col("n") / size).alias("n_blocks"), "digest",
                        F.array().cast(PATH).alias("path"))
    width = 1  # blocks below a node of this round
    while width * size < most:
        open_ = F.col("n_blocks") > width
        digit = (F.floor(F.col("block") / width) % fanout).cast("int")
        lane = F.col("block") % width
        held = F.least(F.lit(width), F.col("n_blocks") - F.floor(F.col("block") / width) * width)
        lanes = F.when(open_ & (held < width), F.sequence(lane, F.lit(width - 1).cast("long"), held)).otherwise(F.array(lane))
        sent = now.select("g", "n_blocks", F.floor(F.col("block") / (width * fanout)).alias("team"), lane.alias("own"),
                          F.explode(lanes).alias("lane"), digit.alias("digit"), "digest", "block", "path")
        mine = F.col("own") == F.col("lane")
        teams = sent.groupBy("g", "n_blocks", "team", "lane").agg(F.sort_array(F.collect_list(F.struct(
            "digit", "digest", F.when(mine, F.col("block")).alias("block"), F.when(mine, F.col("path")).alias("path")))).alias("nodes"))

        def around(member: Column, nodes: Column) -> Column:
            return F.struct(*[F.array_join(F.transform(F.filter(nodes, side), lambda x: x["digest"]), "").alias(name)
                              for name, side in (("before", lambda x: x["digit"] < member["digit"]),
                                                 ("after", lambda x: x["digit"] > member["digit"]))])

        member = F.col("member")
        met = teams.where(F.exists("nodes", lambda x: x["block"].isNotNull())).select(
            "g", "n_blocks", "nodes", F.sha2(F.array_join(F.col("nodes.digest"), ""), 256).alias("ancestor"),
            F.explode(F.filter("nodes", lambda x: x["block"].isNotNull())).alias("member"))
        now = met.select("g", member["block"].alias("block"), "n_blocks",
                         F.when(open_, F.col("ancestor")).otherwise(member["digest"]).alias("digest"),
                         F.when(open_, F.concat(member["path"], F.array(around(member, F.col("nodes")))))
                         .otherwise(member["path"]).alias("path"))
        width *= fanout
    return now.select("g", "block", "digest", "path")


def _tree(leaves: DataFrame, fanout: int, height: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, their upper proofs) of leaves (g, k, leaf, more)."""
    blocks = _blocks(_placed(leaves), fanout, height)
    return blocks, stored(_butterfly(blocks, fanout, height), "manifest-proofs")


def _members(blocks: DataFrame, upper: DataFrame, fanout: int, height: int) -> DataFrame:
    """One row per leaf: g, leaf, more, pos, path within its block followed by ``upper``'s path; more columns of ``upper`` pass."""
    extra = [c for c in upper.columns if c not in ("g", "block", "path")]
    joined = _joined(blocks.drop("digest"), upper, "g", "block").select(
        "g", "n", "members", F.col("path").alias("above"), *extra)

    def step(level: Column, k: int, at: Column) -> Column:
        node = F.floor(at / fanout ** k).cast("int")
        digit = node % fanout
        sides = F.struct(F.array_join(F.slice(level, node - digit + 1, digit), "").alias("before"),
                         F.array_join(F.slice(level, node + 2, F.lit(fanout - 1) - digit), "").alias("after"))
        return F.when(F.col("n") > fanout ** k, F.array(sides)).otherwise(F.array().cast(PATH))

    def own(at: Column) -> Column:
        return F.concat(*[step(F.col(f"level{k}"), k, at) for k in range(height)])

    rows = _with_levels(joined, fanout, height).select(
        "g", "above", *extra, F.explode(F.transform(
            "members", lambda m, i: F.struct(m["pos"].alias("pos"), m["leaf"].alias("leaf"), m["more"].alias("more"),
                                             own(i).alias("path")))).alias("m"))
    return rows.select("g", "m.leaf", "m.more", "m.pos", F.concat("m.path", "above").alias("path"), *extra)


def proofs(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(g, leaf, more, pos, path, subroot, root) for leaves (g, k, leaf, more): group, key, digest and what else a row
    carries (a struct of types that can be ordered)."""
    blocks, upper = _tree(leaves, fanout, height)
    subroots = upper.where("block = 0").select(F.lit(0).alias("g"), F.col("g").alias("k"), F.col("digest").alias("leaf"),
                                               F.struct(F.col("g").alias("of")).alias("more"))
    tops, above = _tree(subroots, fanout, height)
    top = _members(tops, above.withColumnRenamed("digest", "root"), fanout, height).select(
        F.col("more.of").alias("g"), F.col("path").alias("top"), "root")
    whole = _joined(upper, top, "g").select(
        "g", "block", F.concat("path", "top").alias("path"), F.col("digest").alias("subroot"), "root")
    return _members(blocks, whole, fanout, height)


def op11_merkle(spark, sf_dir) -> DataFrame:
    """Every ``documents`` row proved against the root of the table, and a lower-cased third of them tried against it."""
    docs = table(spark, sf_dir, "documents")
    fields = {name: F.col(name) for name in FIELDS}
    tried = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = fields | {"text": F.translate("text", UPPER, LOWER)}
    leaf = leaf_digest(*fields.values())
    leaves = docs.select(F.col("lang").alias("g"), F.col("doc_id").alias("k"), leaf.alias("leaf"), F.struct(
        "doc_id", F.when(tried, leaf_digest(*tampered.values())).alias("tampered")).alias("more"))
    back = folded(F.col("path"), F.coalesce("more.tampered", "leaf"))
    return proofs(leaves).select(
        "more.doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
        back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the SQL below spells out: 8 ** 10 leaves a tree.
SQL_LEVELS = 10


def _crc_half_bytes() -> list[int]:
    """CRC-32 of the 16 half bytes, from its polynomial."""
    out = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def _sql() -> str:
    half = str(_crc_half_bytes())
    step = f"list_reduce([c, b & 15, b >> 4], lambda c, b: xor({half}[1 + (xor(c, b) & 15)], c >> 4))"
    crc = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
           "[CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]), "
           f"lambda c, b: {step}), CAST(4294967295 AS BIGINT))")

    def leaf(text: str) -> str:
        values = [text if f == "text" else f for f in FIELDS]
        return "sha256(" + " || ".join(
            f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + ")"

    def tree(name: str, leaves: str) -> tuple[list[str], str]:
        """CTEs of one tree over ``leaves`` (id, g, i, h, n, f): at last (id, h top, f folded, p siblings)."""
        ctes = [f"{name}_n0 AS MATERIALIZED (SELECT DISTINCT g, i, h, n FROM {leaves})",
                f"{name}_p0 AS MATERIALIZED (SELECT id, g, i, n, f, h, '' AS p FROM {leaves})"]
        for k in range(SQL_LEVELS):
            ctes.append(f"{name}_r{k} AS MATERIALIZED (SELECT g, i // 8 AS r, list(h ORDER BY i) AS hs, any_value(n) AS n "
                        f"FROM {name}_n{k} GROUP BY g, i // 8)")
            ctes.append(f"{name}_n{k + 1} AS MATERIALIZED (SELECT g, r AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) "
                        f"ELSE hs[1] END AS h, (n + 7) // 8 AS n FROM {name}_r{k})")
            left, right = "array_to_string(hs[1:i % 8], '')", "array_to_string(hs[i % 8 + 2:], '')"
            ctes.append(
                f"{name}_p{k + 1} AS MATERIALIZED (SELECT id, p.g, i // 8 AS i, (p.n + 7) // 8 AS n, "
                f"CASE WHEN p.n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f, "
                f"CASE WHEN p.n > 1 THEN sha256(array_to_string(hs, '')) ELSE h END AS h, "
                f"CASE WHEN p.n > 1 THEN p || {left} || {right} ELSE p END AS p "
                f"FROM {name}_p{k} p JOIN {name}_r{k} r ON p.g IS NOT DISTINCT FROM r.g AND p.i // 8 = r.r)")
        return ctes, f"{name}_p{SQL_LEVELS}"

    low, low_end = tree("a", "ranked")
    high, high_end = tree("b", "tops")
    return "WITH " + ",\n".join([
        f"d AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN ({crc}) % 3 = 0 "
        f"THEN {leaf(f'''translate(text, '{UPPER}', '{LOWER}')''')} END AS tampered FROM documents)",
        "ranked AS MATERIALIZED (SELECT row_number() OVER () AS id, lang AS g, doc_id, leaf AS h, coalesce(tampered, leaf) AS f, "
        "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "count(*) OVER (PARTITION BY lang) AS n FROM d)",
        *low,
        # Subroots; the folded ones go on from their own value.
        f"subroots AS MATERIALIZED (SELECT DISTINCT g AS of, h FROM {low_end})",
        "tops AS MATERIALIZED (SELECT l.id, 0 AS g, s.i, s.h, s.n, l.f FROM "
        "(SELECT of, h, row_number() OVER (ORDER BY encode(of) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM subroots) s "
        f"JOIN {low_end} l ON s.of IS NOT DISTINCT FROM l.g)",
        *high]) + (
        "\nSELECT r.doc_id, r.h AS leaf, l.h AS subroot, t.h AS root, sha256(l.p || t.p) AS proof_sha256, "
        f"t.f AS folded_root, t.f = t.h AS verified FROM ranked r JOIN {low_end} l USING (id) JOIN {high_end} t USING (id)")


OP11_SQL = _sql()
