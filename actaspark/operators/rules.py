"""Rule packs: ordered tags with conditions over named patterns, compiled to one expression.

A pack is data. Its patterns are regular expressions with the part of the text they look at; its rules say,
in order, which tag is given under which condition. A condition is a boolean expression over pattern names;
``before("x")`` holds if an earlier rule, or an earlier pack, gave a tag that starts with x. Rules of one chain are alternatives:
the first that holds wins. A rule's ``guard`` is a further condition that many rules share. ``{n}`` in a tag
is the number that the named pattern's group captured.

Each pattern is evaluated once per text, behind a cheap test for a word that it can't match without, so long
texts without court vocabulary cost no regular expression."""

from __future__ import annotations

import ast
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions.dates import number_of

#: Case-insensitive with Unicode classes, and only \n ends a line.
FLAGS = "(?iUd)"


@dataclass(frozen=True)
class Pattern:
    regex: str
    head: int | None = None
    flags: str = FLAGS
    needs: str | None = None


@dataclass(frozen=True)
class Rule:
    tag: str
    when: str
    chain: str | None = None
    guard: str | None = None
    number: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class Pack:
    patterns: dict[str, Pattern]
    rules: tuple[Rule, ...]
    distinct: bool = True
    cut: int | None = None


def _scope(text: Column, p: Pattern) -> Column:
    return F.substring(text, 1, p.head) if p.head else text


def _matches(text: Column, p: Pattern) -> Column:
    own = _scope(text, p)
    hit = own.rlike(p.flags + p.regex)
    return F.contains(F.lower(own), F.lit(p.needs)) & hit if p.needs else hit


class _Condition(ast.NodeVisitor):
    """Turns a condition into a Column; names are looked up in ``known``."""

    def __init__(self, known: dict[str, Column], given: list[tuple[str, Column]], earlier: Column | None = None):
        self.known, self.given, self.earlier = known, given, earlier

    def visit_Expression(self, node):
        return self.visit(node.body)

    def visit_Name(self, node):
        return self.known[node.id]

    def visit_BoolOp(self, node):
        parts = [self.visit(v) for v in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if isinstance(node.op, ast.And) else out | p
        return out

    def visit_UnaryOp(self, node):
        return ~self.visit(node.operand)

    def visit_Call(self, node):
        starts = tuple(a.value for a in node.args)
        out = F.lit(False)
        for tag, fired in self.given:
            if tag.startswith(starts):
                out = out | fired
        if self.earlier is not None:
            out = out | F.exists(self.earlier, lambda t: reduce(or_, [F.startswith(t, F.lit(s)) for s in starts]))
        return out

    def generic_visit(self, node):
        raise ValueError(f"not a condition: {ast.dump(node)}")


def tag_array(pack: Pack, known: dict[str, Column], text: Column, earlier: Column | None = None) -> Column:
    """The pack's tags, in order, given its patterns' truth and the tags of earlier packs."""
    given: list[tuple[str, Column]] = []
    out, chains = [], {}
    for rule in pack.rules:
        of = lambda s: _Condition(known, given, earlier).visit(ast.parse(s, mode="eval"))
        fired = of(rule.when)
        if rule.guard:
            fired = fired & of(rule.guard)
        if rule.chain:
            taken = chains.get(rule.chain)
            chains[rule.chain] = fired if taken is None else taken | fired
            fired = fired if taken is None else fired & ~taken
        tag = F.lit(rule.tag)
        if rule.number:
            n = F.coalesce(*[number_of(F.when(known[name], F.regexp_extract(_scope(text, pack.patterns[name]), pack.patterns[name].flags + pack.patterns[name].regex, group))) for name, group in rule.number])
            before, after = rule.tag.split("{n}")
            tag = F.concat(F.lit(before), n.cast("string"), F.lit(after))
        given.append((rule.tag, fired))
        out.append(F.when(fired, tag))
    tags = F.filter(F.array(*out), lambda t: t.isNotNull())
    return F.array_distinct(tags) if pack.distinct else tags


def with_tags(df: DataFrame, pack: Pack, text: str = "text", out: str = "tags", earlier: Column | None = None) -> DataFrame:
    """``df`` with the pack's tags of ``text``; null texts have none. ``earlier``: tags of packs that ran before."""
    t = F.coalesce(F.col(text), F.lit(""))
    t = F.substring(t, 1, pack.cut) if pack.cut else t
    flags = F.struct(*[_matches(t, p).alias(name) for name, p in pack.patterns.items()])
    held = f"_{out}_matches"
    known = {name: F.col(f"{held}.{name}") for name in pack.patterns}
    return df.withColumn(held, flags).withColumn(out, tag_array(pack, known, t, earlier)).drop(held)
