"""Prefix trie of conversations that are put together from parts of stored ones, by fingerprints that compose."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .ordering import number_rows, running_sums

#: Fingerprints are four sums modulo this prime.
PRIME = (1 << 31) - 1
PARTS = range(4)
DIGIT = 6  # bits of an exponent that one table of powers covers
DIGITS = 7


def bases(seed: int) -> list[int]:
    """A multiplier for each part, from 2 to PRIME - 2, by Knuth's multiplicative step."""
    return [2 + (6364136223846793005 * (4 * seed + i + 1) + 1442695040888963407) % (1 << 64) % (PRIME - 3) for i in PARTS]


def power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo PRIME for exponents from 0 below 2 ** 42, digit by digit."""
    out = F.lit(1).cast("long")
    for d in range(DIGITS):
        step = pow(base, 1 << (DIGIT * d), PRIME)
        values = F.array(*[F.lit(pow(step, k, PRIME)).cast("long") for k in range(1 << DIGIT)])
        out = out * values[F.shiftright(exponent, DIGIT * d).bitwiseAND((1 << DIGIT) - 1).cast("int")] % PRIME
    return out


def packed(parts: list[Column]) -> list[Column]:
    """Four parts below 2 ** 31 as two longs."""
    return [F.shiftleft(parts[0], 31) + parts[1], F.shiftleft(parts[2], 31) + parts[3]]


def prefix_trie(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], longest_head: int, tries: int = 3) -> tuple[DataFrame, DataFrame]:
    """Nodes of the prefix trie of all rebuilt conversations, and the conversations that end in each.

    Conversation c is rebuilt from the first ``head(c)`` turns of conversation ``base(c)`` (all, if it has fewer; none,
    if there is none) and its own turns after its first ``head(c)``. ``head`` is at most ``longest_head``. Nodes:
    depth, fa, fb (the fingerprint), conv_id (smallest member), parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens. Ends: depth, fa, fb, conv_id.

    Turns stand by turn (null first), then role, then SHA-256 of the turn; null roles and texts are empty. Rows without
    conv_id belong to no conversation and are left out. An empty table has no nodes. Equal rows are turns of their own.

    A turn's letter comes from the SHA-256 of its role and text. The product of a stretch of turns is a polynomial in
    a fixed base, so that of head and suffix together is ``head + shift * (own prefix - own head)``: no rebuilt text is
    made, and only ids, digests and numbers move. The digest refers to the stored turn: texts of one digest are compared
    where they are stored, and all members of a group must refer to one turn and one parent, so that groups are equal
    sequences by induction over the depth. Where a check fails, the next base is taken; after ``tries`` it is an error.

    One conversation, turn or prefix may hold most rows: turns are sorted by range and summed in blocks, groups are
    merged before the shuffle. Subtree totals need no walk: a node's leaves and savings are sums over its members of
    what each represents as smallest member, less what its own smallest member represents above it.
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "trie")
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # no two turns share one
    told = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), marked.alias("told"), F.length(text).cast("long").alias("chars"), F.unhex(F.sha2(marked, 256)).alias("ref"))
    if not told.groupBy("ref").agg((F.min("told") != F.max("told")).alias("clash")).where("clash").isEmpty():
        raise ValueError("two turns share a SHA-256")
    rows = number_rows(told.drop("told"), ["conv_id", "turn", "role", "ref"], scratch, "rows")
    rows = scratch.write(running_sums(rows.select("conv_id", "pos", "ref", "chars"), "conv_id", "pos", {"ord": F.lit(1).cast("long")}), "ordered")
    for seed in range(tries):
        members = scratch.write(_members(rows, base, head, longest_head, bases(seed)), f"members-{seed}")
        groups = members.groupBy("depth", "fa", "fb").agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.min("chars").alias("chars"),
            *[f(c).alias(f"{n}_{c}") for c in ("ref", "pa", "pb") for n, f in (("least", F.min), ("most", F.max))],
        )
        groups = scratch.write(groups, f"groups-{seed}")
        differ = [F.col(f"least_{c}") != F.col(f"most_{c}") for c in ("ref", "pa", "pb")]
        if groups.where(differ[0] | differ[1] | differ[2]).isEmpty():
            break
    else:
        raise ValueError("fingerprints of different prefixes are equal")
    nodes = groups.select("depth", "fa", "fb", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saves"), F.col("least_pa").alias("pa"), F.col("least_pb").alias("pb"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "fa", "fb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    # What the nodes of one smallest member save from its first one down to each.
    nodes = scratch.write(running_sums(nodes, "conv_id", "depth", {"down": F.col("saves")}), "nodes")
    shown = nodes.groupBy("conv_id").agg(F.sum("saves").alias("all_saves"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    sums = members.join(shown, "conv_id").groupBy("depth", "fa", "fb").agg(F.sum("all_saves").alias("all_saves"), F.sum("leaves").alias("n_leaves"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, ["depth", "fa", "fb"]).join(above, ["depth", "pa", "pb"], "left")
    out = out.select("depth", "fa", "fb", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("all_saves") - F.col("down") + F.col("saves")).alias("saved_tokens"))
    return out, members.where("ends").select("depth", "fa", "fb", "conv_id")


def _members(rows: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], longest_head: int, multipliers: list[int]) -> DataFrame:
    """(depth, fa, fb, pa, pb, ref, chars, conv_id, ends): every prefix of every rebuilt conversation, the empty one too."""
    letters = [F.pmod(F.xxhash64("ref", F.lit(i)), F.lit(PRIME)) * power(multipliers[i], F.col("ord")) % PRIME for i in PARTS]
    own = rows.select("*", *[x.alias(f"t{i}") for i, x in zip(PARTS, letters, strict=True)])
    own = running_sums(own, "conv_id", "ord", {f"p{i}": F.col(f"t{i}") for i in PARTS})
    own = own.select("conv_id", "ord", "ref", "chars", *[(F.col(f"p{i}") % PRIME).alias(f"p{i}") for i in PARTS], *[F.pmod(F.col(f"p{i}") - F.col(f"t{i}"), F.lit(PRIME)).alias(f"b{i}") for i in PARTS])
    step = F.struct("ord", "ref", "chars", *[f"p{i}" for i in PARTS], *[f"b{i}" for i in PARTS])
    heads = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("ord") <= longest_head, step))).alias("turns"), F.max("ord").alias("n"))
    plan = heads.select("conv_id", "n", "turns", base(F.col("conv_id")).cast("long").alias("base"), head(F.col("conv_id")).cast("int").alias("h"))
    lent = heads.select(F.col("conv_id").alias("base"), F.col("turns").alias("lent"))
    plan = plan.join(lent, "base", "left").withColumn("lent", F.slice(F.coalesce("lent", F.array().cast(lent.schema["lent"].dataType)), F.lit(1), F.col("h")))
    m = F.size("lent")
    zero = F.lit(0).cast("long")
    taken = [F.when(m > 0, F.element_at("lent", -1)[f"p{i}"]).otherwise(zero).alias(f"head{i}") for i in PARTS]
    passed = [F.when((F.col("h") > 0) & (F.col("n") >= F.col("h")), F.get("turns", F.col("h") - 1)[f"p{i}"]).otherwise(zero).alias(f"own{i}") for i in PARTS]
    turn_back = [power(pow(multipliers[i], -1, PRIME), (F.col("h") - m).cast("long")).alias(f"shift{i}") for i in PARTS]
    length = (m + F.greatest(F.col("n") - F.col("h"), zero)).cast("long")
    plan = plan.select("conv_id", "h", "lent", m.alias("m"), length.alias("length"), *taken, *passed, *turn_back)

    def rest(prefix: str) -> list[Column]:
        return [(F.col(f"head{i}") + F.col(f"shift{i}") * F.pmod(F.col(f"{prefix}{i}") - F.col(f"own{i}"), F.lit(PRIME))) % PRIME for i in PARTS]

    def named(depth: Column, now: list[Column], before: list[Column], ref: Column, chars: Column) -> list[Column]:
        keys = zip(("fa", "fb", "pa", "pb"), packed(now) + packed(before), strict=True)
        return [depth.cast("long").alias("depth"), *[k.alias(n) for n, k in keys], ref.alias("ref"), chars.alias("chars"), F.col("conv_id"), (depth == F.col("length")).alias("ends")]

    top = plan.select(*named(zero, [zero] * 4, [zero] * 4, F.lit(b""), zero))
    first = plan.select("conv_id", "length", F.explode("lent").alias("s"))
    first = first.select(*named(F.col("s.ord"), [F.col(f"s.p{i}") for i in PARTS], [F.col(f"s.b{i}") for i in PARTS], F.col("s.ref"), F.col("s.chars")))
    after = own.join(plan.drop("lent"), "conv_id").where("ord > h")
    after = after.select(*named(F.col("ord") - F.col("h") + F.col("m"), rest("p"), rest("b"), F.col("ref"), F.col("chars")))
    return top.unionByName(first).unionByName(after)
