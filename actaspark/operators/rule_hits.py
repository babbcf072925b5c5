"""Rule packs as a table function of SQL: a row for each tag that a text gets, with the place that gave it.

    register(spark, {"enterprise": enterprise.PACK})
    SELECT d.id, h.tag, h.place FROM decisions d, LATERAL rule_hits(d.text, 'enterprise') h
    SELECT * FROM rule_hits(TABLE(SELECT id, text FROM decisions), 'enterprise')

The output follows the arguments: of a text it is (tag, place); of a table with a ``text`` column it has the table's other
columns before them. ``place`` counts code points from 0 and is the first match of the patterns that the rule's condition
asks for, null for rules that only ask what isn't there. Tags agree with ``rules.with_tags``, which is the faster way where
places aren't wanted: it stays in the JVM, while rows of a table function go through Python. Null texts have no rows."""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterator

import regex
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from actaspark.functions.dates import NUMBER_WORDS

from .rules import Pack, Pattern

_NUMBERS = {w: i for i, w in enumerate(NUMBER_WORDS, 1)} | {"une": 1, "vingt": 20}
HIT = [T.StructField("tag", T.StringType(), False), T.StructField("place", T.IntegerType())]


def _compiled(p: Pattern) -> Callable[[str, str], regex.Match | None]:
    letters = p.flags.strip("(?)")
    search = regex.compile(p.regex, (regex.I if "i" in letters else 0) | (regex.S if "s" in letters else 0)).search

    def first(text: str, lowered: str):
        if p.needs and p.needs not in (lowered[: p.head] if p.head else lowered):
            return None
        return search(text[: p.head] if p.head else text)

    return first


def _condition(node: ast.expr, known: dict, before: Callable[..., bool]) -> bool:
    match node:
        case ast.Name(id=name):
            return known[name] is not None
        case ast.BoolOp(op=ast.And(), values=values):
            return all(_condition(v, known, before) for v in values)
        case ast.BoolOp(op=ast.Or(), values=values):
            return any(_condition(v, known, before) for v in values)
        case ast.UnaryOp(op=ast.Not(), operand=operand):
            return not _condition(operand, known, before)
        case ast.Call(args=args):
            return before(*(a.value for a in args))
    raise ValueError(f"not a condition: {ast.dump(node)}")


def _asked(node: ast.expr) -> list[str]:
    """The patterns that a condition wants to match."""
    match node:
        case ast.Name(id=name):
            return [name]
        case ast.BoolOp(values=values):
            return [n for v in values for n in _asked(v)]
    return []


def _number(said: str) -> str:
    said = said.strip().lower()
    return said.lstrip("0") or "0" if said.isascii() and said.isdigit() and len(said) <= 4 else str(_NUMBERS.get(said, ""))


class _Lazy(dict):
    """Patterns are looked for when a condition asks for them, once a text."""

    def __init__(self, patterns, text: str):
        super().__init__()
        self.patterns, self.text, self.lowered = patterns, text, text.lower()

    def __missing__(self, name: str):
        self[name] = found = self.patterns[name](self.text, self.lowered)
        return found


class Matcher:
    """A pack ready to be applied to texts."""

    def __init__(self, pack: Pack):
        tree = lambda s: ast.parse(s, mode="eval").body if s else None
        self.pack = pack
        self.patterns = {name: _compiled(p) for name, p in pack.patterns.items()}
        self.rules = [(r, tree(r.when), tree(r.guard), _asked(tree(r.when))) for r in pack.rules]

    def hits(self, text: str | None) -> Iterator[tuple[str, int | None]]:
        if text is None:
            return
        text = text[: self.pack.cut] if self.pack.cut else text
        known = _Lazy(self.patterns, text)
        given: list[str] = []
        chains, shown = set(), set()
        before = lambda *starts: any(t.startswith(starts) for t in given)
        for rule, when, guard, asked in self.rules:
            if rule.chain in chains or not _condition(when, known, before) or (guard and not _condition(guard, known, before)):
                continue
            if rule.chain:
                chains.add(rule.chain)
            given.append(rule.tag)
            tag = rule.tag
            if rule.number:
                numbers = [n for name, group in rule.number if known[name] and (n := _number(known[name][group] or ""))]
                if not numbers:
                    continue
                tag = tag.replace("{n}", numbers[0])
            if self.pack.distinct and tag in shown:
                continue
            shown.add(tag)
            yield tag, min((known[n].start() for n in asked if known[n]), default=None)


def table_function(packs: dict[str, Pack]):
    """The function's class over the named packs."""

    class RuleHits:
        @staticmethod
        def analyze(source: AnalyzeArgument, pack: AnalyzeArgument) -> AnalyzeResult:
            if pack.value not in packs:
                raise ValueError(f"pack must be one of {sorted(packs)}")
            rest = [f for f in source.dataType.fields if f.name != "text"] if source.isTable else []
            if source.isTable and len(rest) == len(source.dataType.fields):
                raise ValueError("the table needs a column named text")
            return AnalyzeResult(T.StructType([*rest, *HIT]))

        def __init__(self):
            self.matcher = None

        def eval(self, source, pack: str):
            if self.matcher is None:
                self.matcher = Matcher(packs[pack])
            if source is None or isinstance(source, str):
                yield from self.matcher.hits(source)
                return
            row = source.asDict()
            text = row.pop("text")
            for hit in self.matcher.hits(text):
                yield (*row.values(), *hit)

    return RuleHits


def register(spark: SparkSession, packs: dict[str, Pack], name: str = "rule_hits") -> None:
    spark.udtf.register(name, udtf(table_function(packs)))
