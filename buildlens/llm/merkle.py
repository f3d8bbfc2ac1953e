"""Merkle manifest of a table: leaf coordinates by bitmap rank, tree levels by keyed slot arrays.

1. Every row's fields are hashed to a leaf.
2. The ids of a group are a bitmap, compressed by holding only the 64-bit words that are not empty; Spark merges them with
   a bitwise aggregate. A directory of counts stands over them: words in blocks of 2**16 ids, these in ranges of 2**32, of
   2**48, and of all. A row's place in its group is the sum of what the directory counts before its word and of the bits
   before its own. So no group is ever sorted: the longest run that is put in order is one range's, of 65,536 entries.
3. A level of the tree is one shuffle: nodes go to the key (group, slot / 16), where up to 16 digests become their parent.
4. Down again the siblings of each run are handed to the runs below, sixteen times fewer rows than nodes, and every leaf
   gets its proof within its own run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from buildlens.llm.common import written
from buildlens.operators.joins import join_grouped

#: Nodes that make one node of the next level, and the bits of that number.
FAN, SHIFT = 16, 4
#: Bits of an id within a word, and the further bits that each level of the directory takes away.
WORD, DIRECTORY = 6, (10, 16, 16)
#: Copies of one row that are numbered at once.
COPIES = 1 << 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' text in a row."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value."""
    own = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))


def leaf(text: Column) -> Column:
    return digest(*[field(text if c == "text" else F.col(c)) for c in FIELDS])


def ranks(items: DataFrame, group: list[str], value: str, weight: str) -> DataFrame:
    """``items`` with ``rank``, the weight of the items of the group with a smaller value, and ``total``, of all of them.

    Values are 64-bit integers, different within a group; a null one comes before all others. Group columns are not null.
    """
    own = items.withColumns({"_null": F.col(value).isNull(), "_value": F.coalesce(F.col(value), F.lit(0).cast("long"))})
    own = own.withColumns({"_word": F.shiftright("_value", WORD), "_bit": F.col("_value").bitwiseAND(F.lit(63)).cast("int")})
    key = [*group, "_null", "_word"]
    more = F.when(F.col(weight) > 1, F.struct(F.col("_bit").alias("bit"), (F.col(weight) - 1).alias("more")))
    words = own.groupBy(*key).agg(
        F.bit_or(_shifted(1, "_bit")).alias("_bits"),
        # at most 64: the values of a word that weigh more than one
        F.collect_list(more).alias("_more"),
        F.sum(weight).alias("_n"),
    )
    # counts of every level, from the words up, and then the sums of what is before, from the top down
    levels = [words]
    for i, bits in enumerate(DIRECTORY):
        names = [f"_l{j}" for j in range(i)]
        above = levels[-1].withColumn(f"_l{i}", F.shiftright("_word" if not i else names[-1], bits))
        levels[-1] = above
        levels.append(above.groupBy(*group, "_null", f"_l{i}").agg(F.sum("_n").alias("_n")))
    top = f"_l{len(DIRECTORY) - 1}"
    inside = _before([*group], [F.col("_null").desc(), F.col(top)])
    total = F.sum("_n").over(_whole(group)).alias("total")
    directory = levels[-1].select(*group, "_null", top, inside.alias("_base"), total)
    for i in reversed(range(len(DIRECTORY))):
        parent, child = f"_l{i}", (f"_l{i - 1}" if i else "_word")
        here = levels[i].withColumn("_inside", _before([*group, "_null", parent], [F.col(child)]))
        keep = [*group, "_null", child, "total", (F.col("_base") + F.col("_inside")).alias("_base")]
        directory = here.join(directory, [*group, "_null", parent]).select(*keep, *([] if i else ["_bits", "_more"]))
    joined = own.join(directory, key)
    below = F.col("_bits").bitwiseAND(F.bitwise_not(_shifted(-1, "_bit")))
    extra = F.aggregate(
        "_more", F.lit(0).cast("long"), lambda s, m: s + F.when(m["bit"] < F.col("_bit"), m["more"]).otherwise(F.lit(0))
    )
    return joined.select(*items.columns, (F.col("_base") + F.bit_count(below) + extra).alias("rank"), "total")


def _shifted(value: int, bits: str) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), F.col(bits))


def _whole(group: list[str]) -> WindowSpec:
    return Window.partitionBy(*group)


def _before(group: list[str], order: list[Column]) -> Column:
    """The sum of ``_n`` over the earlier rows of a part of the directory."""
    window = _whole(group).orderBy(*order)
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def placed(leaves: DataFrame) -> DataFrame:
    """group, doc_id, leaf, tampered, slot, width: every leaf at its place among the ``width`` of its group.

    ``leaves`` has one row for equal rows, with their number ``copies``. Ids come in ascending order, a null one first;
    rows of the same id by their leaf.
    """
    ids = leaves.groupBy("group", "doc_id").agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"))
    ids = written(ranks(ids, ["group"], "doc_id", "n"), "ids")
    keyed = leaves.withColumns({"_id": F.coalesce("doc_id", F.lit(0)), "_none": F.col("doc_id").isNull()})
    known = ids.select(
        "group", F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), "rank", "total", "kinds"
    )
    placed_ = join_grouped(keyed, known, ["group", "_id", "_none"])
    alone = placed_.filter("kinds = 1").withColumn("at", F.col("rank"))
    # rows of one id that differ: a second index, over the first 60 bits of their leaves and, should these agree, the rest
    tied = placed_.filter("kinds > 1").withColumn("prefix", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long"))
    prefixes = tied.groupBy("group", "_id", "_none", "prefix").agg(F.sum("copies").alias("n")).select(
        "group", "_id", "_none", "prefix", "n"
    )
    within = ranks(prefixes, ["group", "_id", "_none"], "prefix", "n")
    within = within.select("group", "_id", "_none", "prefix", F.col("rank").alias("inner"))
    window = _whole(["group", "_id", "_none", "prefix"]).orderBy("leaf", "tampered")
    among = F.coalesce(F.sum("copies").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tied = tied.withColumn("among", among).join(within, ["group", "_id", "_none", "prefix"])
    tied = tied.withColumn("at", F.col("rank") + F.col("inner") + F.col("among"))
    columns = ["group", "doc_id", "leaf", "tampered", "copies", "at", F.col("total").alias("width")]
    both = alone.select(*columns).union(tied.select(*columns))
    # equal rows take consecutive slots, numbered in pieces
    pieces = both.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("piece") + COPIES, F.col("copies")) - 1
    each = pieces.withColumn("copy", F.explode(F.sequence("piece", last)))
    return each.select("group", "doc_id", "leaf", "tampered", (F.col("at") + F.col("copy")).alias("slot"), "width")


def _runs(nodes: DataFrame, payload: list[str], own: str) -> DataFrame:
    """group, slot, width, members, digest: runs of FAN nodes as nodes of the next level.

    Members are structs of the node's slot and payload, in order; ``own`` names its digest among that.
    """
    members = F.array_sort(F.collect_list(F.struct("slot", *payload)))
    runs = nodes.groupBy("group", F.shiftright("slot", SHIFT).alias("up"), F.ceil(F.col("width") / FAN).alias("width")).agg(
        members.alias("members")
    )
    joint = F.array_join(F.transform("members", lambda m: m[own]), "")
    return runs.select("group", F.col("up").alias("slot"), "width", "members", F.sha2(joint, 256).alias("digest"))


def _tree(nodes: DataFrame, payload: list[str], own: str, label: str) -> list[DataFrame]:
    """The written levels above the nodes, until every group has one node."""
    widest = nodes.agg(F.max("width")).first()[0] or 0
    levels = []
    while widest > 1:
        runs = written(_runs(nodes.filter("width > 1"), payload, own), label)
        levels.append(runs)
        nodes, payload, own = runs.select("group", "slot", "width", "digest"), ["digest"], "digest"
        widest = -(-widest // FAN)
    return levels


def _siblings(own: str) -> Column:
    """The digests before and after each member of a run, as one text each; needs ``members`` and the place ``i``."""

    def joined(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda m: m[own]), "")

    before = F.slice("members", F.lit(1), F.col("i"))
    after = F.slice("members", F.col("i") + 2, F.greatest(F.size("members") - F.col("i") - 1, F.lit(0)))
    return F.struct(joined(before).alias("before"), joined(after).alias("after"))


def _below(runs: DataFrame, own: str, *keep: str) -> DataFrame:
    """The members of runs, each with the path from it up: its siblings in the run, then the run's own path."""
    each = runs.select("*", F.posexplode("members").alias("i", "member"))
    path = F.concat(F.array(_siblings(own)), F.col("path")).alias("path")
    return each.select("group", "member.*", path, *keep)


_PATH = "array<struct<before: string, after: string>>"


def manifest(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and source, slot, of every row.

    ``documents`` has doc_id (64-bit integer), source, lang, n_chars, text; other columns are not looked at. Null fields
    are part of the leaf. A null doc_id comes first in its source and is not tampered with. Rows of the same doc_id are
    ordered by their leaf; equal rows stand beside each other, so that each copy has a proof of its own. An empty table
    gives an empty result.
    """
    tampered = F.translate("text", _UPPER, _LOWER)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = documents.select(
        # a null source and any other have different keys, in the order of the sources
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(chosen, leaf(tampered)).alias("tampered"),
    )
    leaves = written(rows.groupBy("group", "doc_id", "leaf", "tampered").agg(F.count("*").alias("copies")), "leaves")
    slots = written(placed(leaves), "slots")
    levels = _tree(slots, ["doc_id", "leaf", "tampered"], "leaf", "level")
    tops = [slots.filter("width = 1").select("group", F.col("leaf").alias("digest"))]
    tops += [runs.filter("width = 1").select("group", "digest") for runs in levels]
    subroots = tops[0]
    for top in tops[1:]:
        subroots = subroots.union(top)
    subroots = written(_numbered(subroots.withColumnRenamed("group", "name")), "subroots")
    sources = _tree(subroots, ["name", "digest"], "digest", "root-level")
    # the root, and the path from each subroot to it
    if sources:
        root = sources[-1].select("digest").first()[0]
        paths = sources[-1].withColumn("path", F.array().cast(_PATH))
        for i in reversed(range(len(sources))):
            below = _below(paths, "digest")
            if i:
                paths = sources[i - 1].join(below.select("group", "slot", "path"), ["group", "slot"])
        paths = below.select(F.col("name").alias("group"), F.col("digest").alias("subroot"), "path")
    else:
        only = subroots.first()
        root = only["digest"] if only else ""
        paths = subroots.select(F.col("name").alias("group"), F.col("digest").alias("subroot"), F.array().cast(_PATH).alias("path"))
    paths = written(paths, "root-paths")
    # from the tops of the groups down
    alone = slots.filter("width = 1").join(paths, "group")
    found = [alone.select("group", "slot", "doc_id", "leaf", "tampered", "path", "subroot")]
    here = None
    for i in reversed(range(len(levels))):
        runs = levels[i]
        started = runs.filter("width = 1").join(paths, "group").select(*runs.columns, "path", "subroot")
        if here is not None:
            handed = runs.filter("width > 1").join(here.select("group", "slot", "path", "subroot"), ["group", "slot"])
            started = started.union(handed.select(*runs.columns, "path", "subroot"))
        own = "digest" if i else "leaf"
        here = _below(started, own, "subroot")
    if here is not None:
        found.append(here.select("group", "slot", "doc_id", "leaf", "tampered", "path", "subroot"))
    every = found[0] if len(found) == 1 else found[0].union(found[1])
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    folded = F.aggregate(
        "path", F.coalesce("tampered", "leaf"), lambda own, s: digest(s["before"], own, s["after"])
    )
    result = every.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        F.when(F.col("group") != "n", F.substring("group", 2, 1 << 30)).alias("source"),
        "slot",
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


def _numbered(subroots: DataFrame) -> DataFrame:
    """All subroots as the nodes of one group, in the order of their names: places within each part of a distributed
    sort, and the parts' sizes before it."""
    ordered = written(subroots.orderBy("name").withColumn("at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("part").agg(F.count("*").alias("_n"))
    parts = parts.select("part", _before([], [F.col("part")]).alias("base"), F.sum("_n").over(_whole([])).alias("width"))
    place = F.col("base") + F.col("at") - F.shiftleft("part", 33)
    return ordered.join(parts, "part").select(F.lit("").alias("group"), "name", "digest", place.alias("slot"), "width")
