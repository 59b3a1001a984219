"""Conversations repaired to a role grammar by generalised LR parsing with weighted edits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .ordering import BLOCK_BITS, block, number_rows

BLANKS = " \t\n\x0b\x0c\r"
END = "$"
#: What a whole conversation may be, by role initials: nothing, or an optional system turn and pairs of user and assistant.
GRAMMAR = {"S": ((), ("s", "P"), ("P",)), "P": (("u", "a"), ("P", "u", "a"))}

Weight = tuple[int, str, str]  # cost, audit, role initial that each edit leaves ("-" where it deletes)


class Stacks:
    """Parse stacks of a grammar as one graph: a node is a state on top of another node, so stacks share what lies below.

    Tables are SLR; where a state allows several actions, all are followed. ``shift`` and ``accepts`` are looked up
    once per node and symbol. ``nodes`` lists every stack that parsing can meet, which is finite where nothing but
    lists recurs (as in role grammars); a grammar that nests without bound is refused.
    """

    def __init__(self, grammar: Mapping[str, Sequence[Sequence[str]]], start: str = "S", most: int = 500) -> None:
        self.rules = [("", (start,))] + [(left, tuple(right)) for left, rights in grammar.items() for right in rights]
        self.terminals = sorted({x for _, right in self.rules for x in right} - set(grammar))
        self.follow = self._follow(grammar, start)
        self.states: list[frozenset] = [self._closure({(0, 0)})]
        self.goto: list[dict[str, int]] = []
        for items in self.states:  # grows while it is walked
            moves: dict[str, set] = {}
            for rule, dot in items:
                if dot < len(self.rules[rule][1]):
                    moves.setdefault(self.rules[rule][1][dot], set()).add((rule, dot + 1))
            row = {}
            for symbol, kernel in moves.items():
                target = self._closure(kernel)
                if target not in self.states:
                    self.states.append(target)
                row[symbol] = self.states.index(target)
            self.goto.append(row)
        self.stack: list[tuple[int, int]] = []  # of a node: its state, the node below
        self.ids: dict[tuple[int, int], int] = {}
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}
        root = self._node(0, -1)
        self.nodes, seen = [root], {root}
        for node in self.nodes:
            for symbol in self.terminals:
                for target in self.shift(node, symbol):
                    if target not in seen:
                        seen.add(target)
                        self.nodes.append(target)
            if len(self.nodes) > most:
                raise ValueError("this grammar nests without bound: its stacks cannot be listed")
        self.index = {node: i for i, node in enumerate(self.nodes)}
        self.accepting = {node for node in self.nodes if any((0, 1) in self.states[self.stack[n][0]] for n in self._reduced(node, END))}

    def _closure(self, kernel: set) -> frozenset:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            for i, (left, _) in enumerate(self.rules):
                if dot < len(right) and left == right[dot] and (i, 0) not in items:
                    items.add((i, 0))
                    todo.append((i, 0))
        return frozenset(items)

    def _follow(self, grammar: Mapping, start: str) -> dict[str, set[str]]:
        """Terminals that may come after each nonterminal, by fixed points over which vanish and what they begin with."""
        empty: set[str] = set()
        first: dict[str, set[str]] = {x: set() for x in grammar}
        follow: dict[str, set[str]] = {x: set() for x in grammar}
        follow[start].add(END)
        before = None
        while before != (before := (len(empty), *(len(s) for s in first.values()), *(len(s) for s in follow.values()))):
            for left, right in self.rules[1:]:
                if all(x in empty for x in right):
                    empty.add(left)
                for x in right:
                    first[left] |= first.get(x, {x})
                    if x not in empty:
                        break
                tail = set(follow[left])
                for x in reversed(right):
                    if x in grammar:
                        follow[x] |= tail
                        tail = tail | first[x] if x in empty else set(first[x])
                    else:
                        tail = {x}
        return follow

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.ids:
            self.ids[state, below] = len(self.stack)
            self.stack.append((state, below))
        return self.ids[state, below]

    def _reduce(self, node: int, rule: int) -> int:
        left, right = self.rules[rule]
        for _ in right:
            node = self.stack[node][1]
        return self._node(self.goto[self.stack[node][0]][left], node)

    def _complete(self, node: int) -> list[int]:
        return [rule for rule, dot in sorted(self.states[self.stack[node][0]]) if rule and dot == len(self.rules[rule][1])]

    def _reduced(self, node: int, ahead: str) -> list[int]:
        """The node and all that reductions make of it in front of ``ahead``."""
        out = [node]
        for n in out:
            for rule in self._complete(n):
                if ahead in self.follow[self.rules[rule][0]] and (new := self._reduce(n, rule)) not in out:
                    out.append(new)
        return out

    def shift(self, node: int, symbol: str) -> tuple[int, ...]:
        """Nodes after ``symbol``. A state with nothing but one finished rule is reduced at once, so equal stacks meet."""
        if (node, symbol) not in self.moves:
            found = []
            for n in self._reduced(node, symbol):
                target = self.goto[self.stack[n][0]].get(symbol)
                if target is not None:
                    new = self._node(target, n)
                    while len(self.states[self.stack[new][0]]) == 1 and self._complete(new):
                        new = self._reduce(new, self._complete(new)[0])
                    found.append(new)
            self.moves[node, symbol] = tuple(dict.fromkeys(found))
        return self.moves[node, symbol]


@dataclass(frozen=True)
class Edits:
    """What edits cost, and which roles a turn may be given or put in with; roles stand for their initials."""

    grammar: tuple = tuple(GRAMMAR.items())
    roles: tuple[str, ...] = ("user", "assistant")
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Parser:
    """Least (cost, audit) from stack to stack over a run of rows; equal tops keep the least.

    A row is one character, see ``row_code``. Audits are compared as text. Those that end at the same row in a kept or
    deleted row hold the same number of such letters, so none begins another, and an order between two of them stays
    whatever is appended: runs of rows may be parsed apart and put together.
    """

    def __init__(self, edits: Edits) -> None:
        self.edits, self.stacks = edits, Stacks(dict(edits.grammar))
        self.initials = self.stacks.terminals
        self.size = len(self.stacks.nodes)
        self.given = [role[0] for role in edits.roles]
        self.run = lru_cache(20_000)(self._run)

    def inserted(self, heads: dict[int, Weight]) -> dict[int, Weight]:
        """Heads with any number of turns put in."""
        todo = list(heads.items())
        while todo:
            node, weight = todo.pop()
            if heads[node] != weight:
                continue
            for symbol in self.given:
                new = (weight[0] + self.edits.insert, weight[1] + "I", weight[2] + symbol)
                for target in self.stacks.shift(node, symbol):
                    if target not in heads or new < heads[target]:
                        heads[target] = new
                        todo.append((target, new))
        return heads

    def _run(self, code: str, start: int) -> dict[int, Weight]:
        heads: dict[int, Weight] = {start: (0, "", "")}
        for row in code:
            kind, fault = divmod(ord(row) - ord("a"), 3)
            after: dict[int, Weight] = {}

            def offer(node: int, weight: Weight) -> None:
                if node not in after or weight < after[node]:
                    after[node] = weight

            for node, (cost, audit, plan) in self.inserted(heads).items():
                offer(node, (cost + self.edits.delete, audit + "D", plan + "-"))
                if fault == 2:
                    continue
                cost += self.edits.truncated * fault
                if kind < len(self.initials):
                    symbol = self.initials[kind]
                    for target in self.stacks.shift(node, symbol):
                        offer(target, (cost, audit + "K", plan + symbol))
                for symbol in self.given:
                    for target in self.stacks.shift(node, symbol):
                        offer(target, (cost + self.edits.rerole, audit + "R", plan + symbol))
            heads = after
        return heads

    def matrix(self, code: str, first: bool) -> tuple[list, list, list, list]:
        """Costs (-1: no way), ranks of the audits of one start, audits and plans, start by start; a first block has one start."""
        costs: list = []
        ranks: list = []
        audits: list = []
        plans: list = []
        for start in self.stacks.nodes[:1] if first else self.stacks.nodes:
            ends = self.run(code, start)
            order = {node: i for i, node in enumerate(sorted(ends, key=lambda n: ends[n][1:]))}
            for node in self.stacks.nodes:
                weight = ends.get(node, (-1, None, None))
                costs.append(weight[0])
                ranks.append(order.get(node, -1))
                audits.append(weight[1])
                plans.append(weight[2])
        return costs, ranks, audits, plans

    def path(self, blocks: Sequence[tuple[Sequence, Sequence]]) -> tuple[int, list[int], str, str]:
        """Cheapest way through all blocks: cost, the entry of each block's matrix, audit and plan of what is put in last."""
        now = {0: (0, 0)}  # of each reached stack: cost, rank of its audit
        back: list[dict[int, int]] = []
        for costs, ranks in blocks:
            best: dict[int, tuple] = {}
            for start, (cost, rank) in now.items():
                for end in range(self.size):
                    at = start * self.size + end
                    if costs[at] >= 0:
                        offer = (cost + int(costs[at]), rank, int(ranks[at]), start)
                        if end not in best or offer < best[end]:
                            best[end] = offer
            order = sorted(best, key=lambda e: best[e][1:3])
            now = {e: (best[e][0], i) for i, e in enumerate(order)}
            back.append({e: best[e][3] for e in best})
        last = []
        for e, (cost, rank) in now.items():
            for node, (more, audit, plan) in self.inserted({self.stacks.nodes[e]: (0, "", "")}).items():
                if node in self.stacks.accepting:
                    last.append((cost + more, rank, audit, plan, e))
        cost, _, audit, plan, end = min(last)
        entries = []
        for links in reversed(back):
            entries.append(links[end] * self.size + end)
            end = links[end]
        return cost, entries[::-1], audit, plan


@lru_cache(4)
def parser(edits: Edits) -> Parser:
    return Parser(edits)


MATRIX = {"cost": "array<long>", "rank": "array<int>", "audit": "array<string>", "plan": "array<string>"}
PATH = {"cost": "long", "entries": "array<int>", "audit": "string", "plan": "string"}
STEPS = {"letters": "string", "roles": "string", "put": "array<struct<at:int,nth:int,role:string>>"}


def fields(schema: Mapping[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in schema.items())


def steps(audit: str, plan: str) -> tuple[str, str, list[dict]]:
    """An audit by rows: letter and role initial of each row, and what is put in before which row."""
    letters: list[str] = []
    roles: list[str] = []
    put: list[dict] = []
    for letter, role in zip(audit, plan, strict=True):
        if letter == "I":
            put.append({"at": len(letters), "nth": len(put), "role": role})
        else:
            letters.append(letter)
            roles.append(role)
    return "".join(letters), "".join(roles), put


def row_code(role: Column, blank_or_twice: Column, cut: Column, initials: Iterable[str]) -> Column:
    """One character a row: its role initial (or none of the grammar's) and whether it must go or was cut short."""
    initials = list(initials)
    kind = F.coalesce(*[F.when(F.substring(role, 1, 1) == x, F.lit(i)) for i, x in enumerate(initials)], F.lit(len(initials)))
    fault = F.when(blank_or_twice, 2).when(cut, 1).otherwise(0)
    return F.char(F.lit(ord("a")) + kind * 3 + fault)


def repair_conversations(turns: DataFrame, edits: Edits = Edits()) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest repair of each conversation, and the repaired turns.

    ``turns`` has conv_id, turn, role and text; other columns are left out. First frame: conv_id, n_rows, gaps, blank,
    duplicate, truncated, illegal, cost, audit. Second: conv_id, pos (rises along a conversation), nth (order at one
    pos), turn (null where put in), role, text, edit (K, R or I; deleted rows are gone).

    Rows stand by turn (null first), then role, then SHA-256 of the text; copies are neighbours. Null roles and texts
    count as empty, so such a row is blank; a null conv_id is a conversation of its own. Two texts are the same where
    their SHA-256 is. An empty table gives two empty frames. Texts may be of any length; no row is left out.

    One conversation may hold most rows: rows are sorted by range, blocks of at most 1024 rows are parsed apart, from
    every stack that may lie before them, and one small matrix a block is put together along a conversation. Only the
    audit, one letter a row, is ever gathered.
    """
    spark = turns.sparkSession
    scratch, reader = Scratch(spark, "repair"), parser(edits)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = number_rows(rows, ["conv_id", "turn", "role", "digest"], scratch, "rows")
    twice = rows.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("seen"), F.count("*").alias("n")).where("n > 1").drop("n")
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = rows.select("conv_id", "turn", "role", "digest", "pos", (stripped == "").alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"))
    facts = facts.alias("r").join(twice.alias("t"), F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("r.role") == F.col("t.role")) & (F.col("r.digest") == F.col("t.digest")), "left").select("r.*", (F.coalesce(F.col("seen") < F.col("pos"), F.lit(False)) & ~F.col("blank")).alias("twice"))
    facts = facts.withColumn("cut", F.col("cut") & ~F.col("blank") & ~F.col("twice"))
    facts = facts.withColumn("code", row_code(F.col("role"), F.col("blank") | F.col("twice"), F.col("cut"), reader.initials))
    facts = facts.withColumn("initial", F.substring("role", 1, 1))
    blocks = facts.groupBy("conv_id", block().alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "code", "initial"))).alias("r"),
        F.min("pos").alias("first"),
        F.count("*").alias("n"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "twice", "cut")],
    )
    pairs = F.transform(F.sequence(F.lit(2), F.size("r")), lambda i: F.concat(F.element_at("r", i - 1)["initial"], F.element_at("r", i)["initial"]))
    illegal = F.when(F.size("r") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0).cast("long")
    blocks = blocks.select("*", F.array_join(F.transform("r", lambda x: x["code"]), "").alias("rows"), F.element_at("r", 1)["initial"].alias("head"), F.element_at("r", -1)["initial"].alias("tail"), illegal.alias("illegal")).drop("r")
    blocks = scratch.write(blocks, "blocks")
    starts = blocks.groupBy("conv_id").agg(F.min("blk").alias("blk")).withColumn("starts", F.lit(True))

    @F.pandas_udf(fields(MATRIX))
    def matrix(rows: pd.Series, first: pd.Series) -> pd.DataFrame:
        p = parser(edits)
        return pd.DataFrame([p.matrix(r, f) for r, f in zip(rows, first, strict=True)], columns=list(MATRIX))

    @F.pandas_udf(fields(PATH))
    def path(blocks: pd.Series) -> pd.DataFrame:
        p = parser(edits)
        return pd.DataFrame([p.path([(b["cost"], b["rank"]) for b in one]) for one in blocks], columns=list(PATH))

    @F.pandas_udf(fields(STEPS))
    def by_row(audit: pd.Series, plan: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([steps(a, p) for a, p in zip(audit, plan, strict=True)], columns=list(STEPS))

    known = blocks.alias("b").join(starts.alias("s"), F.col("b.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("b.blk") == F.col("s.blk")), "left")
    known = known.select("b.*", F.coalesce("starts", F.lit(False)).alias("starts"))
    parsed = scratch.write(known.withColumn("m", matrix("rows", "starts")).drop("rows"), "parsed")
    # Along a conversation: one row a block, costs and ranks only.
    small = F.struct("blk", F.col("m.cost").alias("cost"), F.col("m.rank").alias("rank"), "head", "tail")
    along = parsed.groupBy("conv_id").agg(F.sort_array(F.collect_list(small)).alias("b"), F.sum("n").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in ("blank", "twice", "cut", "illegal")])
    edges = F.transform(F.sequence(F.lit(2), F.size("b")), lambda i: F.concat(F.element_at("b", i - 1)["tail"], F.element_at("b", i)["head"]))
    between = F.when(F.size("b") > 1, F.size(F.filter(edges, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    along = along.withColumn("illegal", F.col("illegal") + between).withColumn("path", path("b")).withColumn("blks", F.col("b.blk")).drop("b")
    along = scratch.write(along, "along")
    entries = along.select("conv_id", F.posexplode(F.arrays_zip("blks", F.col("path.entries").alias("entry"))).alias("i", "e"), F.size("blks").alias("of"), F.col("path.audit").alias("end_audit"), F.col("path.plan").alias("end_plan"))
    is_last = F.col("i") == F.col("of") - 1
    entries = entries.select("conv_id", F.col("e.blks").alias("blk"), F.col("e.entry").alias("entry"), F.when(is_last, F.col("end_audit")).otherwise("").alias("end_audit"), F.when(is_last, F.col("end_plan")).otherwise("").alias("end_plan"))
    chosen = parsed.alias("p").join(entries.alias("e"), F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("p.blk") == F.col("e.blk")))
    chosen = chosen.select("p.conv_id", "p.blk", "first", F.concat(F.col("m.audit")[F.col("entry")], F.col("end_audit")).alias("audit"), F.concat(F.col("m.plan")[F.col("entry")], F.col("end_plan")).alias("plan"))
    chosen = scratch.write(chosen.withColumn("s", by_row("audit", "plan")).drop("plan"), "chosen")

    audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("blk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    numbers = rows.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(F.sum("one").alias("turns"))
    found = along.alias("a").join(audits.alias("t"), F.col("a.conv_id").eqNullSafe(F.col("t.conv_id"))).join(numbers.alias("n"), F.col("a.conv_id").eqNullSafe(F.col("n.conv_id")), "left")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    found = found.select("a.conv_id", "n_rows", gaps.alias("gaps"), "blank", F.col("twice").alias("duplicate"), F.col("cut").alias("truncated"), "illegal", F.col("path.cost").alias("cost"), "audit")

    name = F.coalesce(*[F.when(F.col("initial") == role[0], F.lit(role)) for role in edits.roles])
    here = rows.withColumn("blk", block()).alias("r").join(chosen.alias("c"), F.col("r.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("r.blk") == F.col("c.blk")))
    at = (F.col("pos") - F.col("first") + 1).cast("int")
    kept = here.select("r.conv_id", "pos", F.lit(1 << 30).alias("nth"), "turn", "role", "text", F.substr("s.letters", at, F.lit(1)).alias("edit"), F.substr("s.roles", at, F.lit(1)).alias("initial")).where("edit <> 'D'")
    kept = kept.withColumn("role", F.when(F.col("edit") == "R", name).otherwise(F.col("role"))).drop("initial")
    put = chosen.select("conv_id", "first", F.explode("s.put").alias("p")).select("conv_id", (F.col("first") + F.col("p.at")).alias("pos"), F.col("p.nth").alias("nth"), F.lit(None).cast("long").alias("turn"), F.col("p.role").alias("initial"))
    put = put.select("conv_id", "pos", "nth", "turn", name.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    return found, kept.unionByName(put)
