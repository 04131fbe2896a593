"""Chat formatting of reply trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Fixed value: what follows the first character of a control string that a text may not hold as it is.
TAIL = r"(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|pad\|>|/?s>|/?INST\]|</?SYS>>|/?pad>|/?unk>)"


def escape(text: Column) -> Column:
    """Break every control string by one more backslash after its first character."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + TAIL, r"$1$2\\")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + TAIL, "$1$2")


def escape_role(role: Column) -> Column:
    """A role as one line without control strings."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """The inverse of ``escape_role``."""
    pieces = F.split(unescape(role), r"\\\\", -1)  # at each pair of backslashes, from the left
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def thread_nodes(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations by turn as reply trees: each row answers the one before it.

    Rows follow turn (null first), then role and text, so repeated turns have an order too.
    """
    order = Window.partitionBy(conv_id).orderBy(F.col(turn), "role", "text")
    at = F.row_number().over(order).cast("long")
    return rows.select(
        F.col(conv_id).alias("tree"),
        at.alias("node"),
        F.when(at > 1, at - 1).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def reply_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, path, rank, path_score, at, role, text): the rows of the chosen root-to-leaf paths, root first.

    ``nodes`` has tree, node, parent, role, text, score. Self-joins double how far each node sees towards its
    root, so their number grows with the logarithm of the depth; the same steps backwards list the nodes of the
    chosen leaves' paths only. All branches rank by mean score (null: 0), then by length, then by their leaf; the best
    ``branches`` of a tree are chosen, or all. A parent that is missing makes a root; nodes on or below a circle
    lead to no root and are on no path. Of nodes with the same tree and name, each stands for itself and replies
    go to the first.
    """
    named = written(
        nodes.select("tree", "node", "parent", "role", "text", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    first = named.where(F.col("node").isNotNull()).groupBy("tree", "node").agg(F.min("id").alias("up"))
    a, b = named.alias("a"), first.alias("b")
    steps = [
        written(
            a.join(b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.parent") == F.col("b.node")), "left").select(
                "a.id", "b.up", F.lit(1).cast("long").alias("n"), F.col("a.score").alias("total")
            )
        )
    ]
    rounds = max(named.count(), 1).bit_length()
    while len(steps) <= rounds and not steps[-1].where("up IS NOT NULL").isEmpty():
        a, b = steps[-1].where("up IS NOT NULL").alias("a"), steps[-1].alias("b")
        further = a.join(b, F.col("a.up") == F.col("b.id")).select(
            "a.id", "b.up", (F.col("a.n") + F.col("b.n")).alias("n"), (F.col("a.total") + F.col("b.total")).alias("total")
        )
        steps.append(written(steps[-1].where("up IS NULL").unionByName(further)))
    ends = steps[-1].where("up IS NULL").select("id", "n", (F.col("total") / F.col("n")).alias("path_score"))
    leaves = ends.join(steps[0].select(F.col("up").alias("id")), "id", "left_anti").join(
        named.select("id", "tree"), "id"
    )
    order = [F.desc("path_score"), F.desc("n"), F.asc("id")]
    if branches is not None:  # first within salts of a tree, then among those
        salt = F.pmod(F.xxhash64("id"), F.lit(64))
        leaves = leaves.withColumn("salt", salt)
        within = F.row_number().over(Window.partitionBy("tree", "salt").orderBy(*order))
        leaves = leaves.withColumn("k", within).where(F.col("k") <= branches).drop("k", "salt")
        leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
        leaves = leaves.where(F.col("rank") <= branches)
    else:  # leaves are narrow rows: a sort by tree, which spills
        leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
    leaves = written(leaves)
    spans = leaves.select(F.col("id").alias("path"), "id")
    for step in reversed(steps[:-1]):
        more = spans.join(step.where("up IS NOT NULL").select("id", "up"), "id").select("path", F.col("up").alias("id"))
        spans = written(spans.unionByName(more))
    depth = ends.select("id", F.col("n").alias("at"))
    return (
        spans.join(depth, "id")
        .join(named.select("id", "role", "text"), "id")
        .join(leaves.select(F.col("id").alias("path"), "tree", "rank", "path_score"), "path")
        .select("tree", "path", "rank", "path_score", "at", "role", "text")
    )


def format_paths(rows: DataFrame) -> DataFrame:
    """(tree, path, rank, path_score, formatted, loss_spans): each path as one conversation in the template.

    A turn is the start mark, its role, a line feed, its text, the end mark. Control strings inside texts and roles
    are escaped; null counts as empty. ``loss_spans`` are the (start, length) of the assistant texts, in code points
    of ``formatted``.
    """
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = rows.withColumns({"head": head, "body": escape(F.coalesce("text", F.lit("")))})
    size = F.length("head") + F.length("body") + F.lit(len(END))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("begin", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.length("head"))
    one = F.struct("at", F.concat("head", "body", F.lit(END)).alias("turn"), "begin", F.length("body").alias("size"),
                   F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("loss"))
    whole = turns.groupBy("tree", "path", "rank", "path_score").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    loss = F.filter("turns", lambda t: t["loss"])
    return whole.select(
        "tree", "path", "rank", "path_score",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(loss, lambda t: F.struct(t["begin"].alias("start"), t["size"].cast("long").alias("length"))).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1).substr(F.lit(len(START) + 1), F.length(p))).alias("role"),
            unescape(p.substr(F.locate("\n", p) + 1, F.length(p))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, joined, as they were before escaping."""
    parts = F.transform(spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(parts, "")


def format_trees(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """The best ``branches`` paths of each reply tree (all if None), formatted. An empty table gives no rows."""
    return format_paths(reply_paths(nodes, branches))
