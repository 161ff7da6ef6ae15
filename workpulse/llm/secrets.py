"""Secret scans over a trigram inverted index.

Every rule is a regular expression with a Boolean trigram query, derived here from its pattern: an OR of
ANDs of lower-case trigrams that any match must contain. The index holds one posting (trigram, row) for
each trigram that occurs in a row's text. A rule's candidates come from intersecting postings: per row and
AND-group, all of its trigrams must be there. Only candidates are verified with the
rule's expression. A rule without mandatory trigrams is verified on every row.

All of it is DataFrame operations. Spans are code point offsets: a text is split at the matches, and the
lengths of the pieces and matches add up to the offsets.

Defined cases: a null text is the empty text without spans; rows of equal id and text share their
postings, and each is answered; very long texts are indexed whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re._constants as codes
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern of Java and Python syntax; ``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules, then public formats of keys and tokens.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
#: Most AND-groups of a rule, and most texts that a stretch of a pattern may expand to.
MOST_GROUPS = 64
#: Most trigrams that an AND-group asks for: fewer only make more candidates.
MOST_TRIGRAMS = 62


def _texts(tree) -> list[str | None]:
    """The lower-case texts that a parsed stretch may stand for; None in one breaks it off there."""
    found: list[list[str | None]] = [[]]
    for code, value in tree:
        options: list[list[str | None]]
        if code is codes.LITERAL:
            options = [[chr(value).lower()]]
        elif code is codes.IN:
            chars = _few(value)
            options = [[c] for c in chars] if chars else [[None]]
        elif code is codes.SUBPATTERN:
            options = _texts(value[3])
        elif code is codes.BRANCH:
            options = [o for branch in value[1] for o in _texts(branch)]
        elif code in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            least, most, inner = value
            if (least, most) == (0, 1):
                options = [[], *_texts(inner)]
            elif least:
                # what is repeated stands there once at its start, then anything
                options = [[*o, None] for o in _texts(inner)]
            else:
                options = [[None]]
        else:
            options = [[None]]
        if len(found) * len(options) > MOST_GROUPS:
            options = [[None]]
        found = [[*a, *b] for a, b in product(found, options)]
    return found


def _few(members) -> list[str]:
    """The characters of a small class of single characters, else none."""
    chars = sorted({chr(v).lower() for code, v in members if code is codes.LITERAL})
    return chars if all(code is codes.LITERAL for code, _ in members) and len(chars) <= 8 else []


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams that every match contains; empty if there is none.

    Only ASCII trigrams are asked for, as lower-casing others is not the same everywhere.
    """
    groups = set()
    for text in _texts(parser.parse(pattern)):
        runs = "".join("\n\n\n" if c is None else c for c in text).split("\n\n\n")
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2) if run[i : i + 3].isascii())
        if not grams:
            return []
        groups.add(frozenset(sorted(grams)[:MOST_TRIGRAMS]))
    # a group that holds another one is implied by it
    return sorted((g for g in groups if not any(o < g for o in groups)), key=sorted)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else f"\\x{ord(c):02x}" for c in text)


def _any_of(grams: list[str]) -> str:
    """An expression for one of the trigrams, branching at its first, second and third character."""
    tree: dict[str, dict[str, set[str]]] = {}
    for a, b, c in grams:
        tree.setdefault(a, {}).setdefault(b, set()).add(c)
    branches = []
    for a, seconds in sorted(tree.items()):
        tails = [f"{_quoted(b)}[{''.join(map(_quoted, sorted(cs)))}]" for b, cs in sorted(seconds.items())]
        branches.append(f"{_quoted(a)}(?:{'|'.join(tails)})")
    # one class for the first characters, so that most places are passed by at once
    first = "".join(map(_quoted, sorted(tree)))
    return f"(?=[{first}])(?:{'|'.join(branches)})"


def postings(rows: DataFrame, grams: list[str] | None = None) -> DataFrame:
    """The inverted index of (key, text): one row (trigram, key) for each trigram in a text.

    With ``grams`` only these are indexed; without, every trigram of every text.
    """
    pattern = f"(?=({_any_of(grams)}))" if grams else "(?s)(?=(...))"
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(1)))
    return rows.select(F.explode(found).alias("trigram"), "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the rows that satisfy the trigram query of a rule, by intersecting postings."""
    # a bit for each trigram of a group: repeated postings don't count twice
    asked = [
        (gram, rule.kind, number, 1 << bit, (1 << len(group)) - 1)
        for rule in rules
        for number, group in enumerate(trigram_query(rule.pattern))
        for bit, gram in enumerate(sorted(group))
    ]
    # one row for each trigram of a rule, whatever the data
    terms = index.sparkSession.createDataFrame(asked, "trigram string, kind string, part int, bit long, every long")
    return (
        index.join(F.broadcast(terms), "trigram")
        .groupBy("key", "kind", "part", "every")
        .agg(F.bit_or("bit").alias("there"))
        .where("there = every")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _java(rule: Rule) -> str:
    """The pattern with what ``least`` allows said in it, where a match is one maximal run."""
    if rule.pattern.endswith("]+") and rule.group == 0 and rule.pattern.count("+") == 1:
        fixed = rule.pattern.index("[")
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - fixed)},}}+"
    return rule.pattern


def rule_spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the matches that are long enough: leftmost, not overlapping."""
    pattern = F.lit(_java(rule))
    pieces = F.split(text, _java(rule), -1).alias("before")
    whole = F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole")
    # the piece after the last match comes without a match
    if rule.group:
        zipped = F.arrays_zip(pieces, whole, F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("tested"))
        tested = "tested"
    else:
        zipped, tested = F.arrays_zip(pieces, whole), "whole"
    lengths = F.transform(
        zipped,
        lambda m: F.struct(
            F.length(m["before"]).alias("before"), F.length(m["whole"]).alias("size"), F.length(m[tested]).alias("tested")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, m: Column) -> Column:
        first = state["at"] + m["before"]
        last = first + m["size"]
        span = F.array(F.struct(first.alias("start"), last.alias("end")))
        return F.struct(
            last.alias("at"),
            F.when(m["tested"] >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(lengths, start, step)["spans"]


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row for each row: its id and ``spans``, array<struct<start, place, kind, end>> in order.

    ``place`` is the rule's place in ``rules``: spans are in order of start, then of the rules.
    """
    rows = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text]).alias("text")).withColumn(
        "key", F.unhex(F.md5(F.concat(text_or_empty("id"), F.lit("\n"), "text").cast("binary")))
    )
    indexed = [r for r in rules if trigram_query(r.pattern)]
    grams = sorted({g for r in indexed for group in trigram_query(r.pattern) for g in group})
    if indexed:
        found = candidates(postings(rows, grams), tuple(indexed)).withColumnRenamed("key", "found")
        rows = rows.join(found, F.col("key") == F.col("found"), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")

    def spans_of(place: int, rule: Rule) -> Column:
        # verified only where the index says so; without a query, where there is any match at all
        maybe = F.array_contains("kinds", rule.kind) if rule in indexed else F.col("text").rlike(_java(rule))
        return F.transform(
            F.when(maybe, rule_spans(F.col("text"), rule)).otherwise(none),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")
            ),
        )

    spans = [spans_of(place, rule) for place, rule in enumerate(rules)]
    return rows.select(F.col("id").alias(id_col), F.array_sort(F.concat(*spans)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of the spans, joined with commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
