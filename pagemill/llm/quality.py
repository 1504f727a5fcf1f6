"""Per-document text statistics, and kinds of text by learned rules (problem 5).

The statistics are taken over the whole text with array operations on Arrow batches. An ordered rule list is induced from
labelled texts by incremental reduced-error pruning: for each kind but the last, in the given order, rules
are grown on two thirds of the labelled rows by information gain, pruned on the other third, and kept
while they are right more often than wrong there. The list is exported as one SQL ``CASE`` expression
with the learned thresholds, which Spark applies natively to every text.

The learner sees at most ``max_labels`` labelled rows (by the order of a hash of their keys, so that
the sample is the same wherever it is drawn); only their statistics reach the driver.

Defined results: a null or blank text has word count 0, null for every other statistic and kind null;
ties between kinds fall to the earlier rule; rows that arrive again are classified again; other
columns are carried, one with the name of a statistic as ``<name>_input``; without labels all is prose.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.naming import make_room

# Frequent function words of English, without "of" and "one", which names of things are full of.
COMMON_WORDS = (
    "a", "after", "an", "and", "any", "are", "as", "at", "be", "before", "but", "by", "can", "each", "every", "for", "from", "has", "have", "if", "in", "into", "is", "it", "its", "may",
    "more", "must", "never", "not", "on", "only", "or", "than", "that", "the", "their", "then", "they", "this", "to", "too", "unless", "until", "when", "which", "who", "will", "with", "without", "you", "your",
)

#: Statistics of a text; the first five are those of the problem, the others tell its shape.
STATISTICS = ("word_count", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words", "words_per_line", "marked_lines", "continued_lines", "digit_ratio", "short_word_ratio", "word_like", "leading_capitals", "commas_per_word")
#: Statistics the rules may use: those that don't depend on the length of a text or of its words. Of
#: two that tell as much the earlier one is taken.
RULE_STATISTICS = ("common_words", "word_like", "marked_lines", "leading_capitals", "commas_per_word", "continued_lines", "symbol_ratio", "digit_ratio", "words_per_line", "short_word_ratio", "punctuated_lines")
KINDS = ("table", "junk", "list", "prose")

_HEADING = re.compile(r"<<<HEADING:.*?>>>\s*")
#: A running head set with spaces between its letters.
_SPACED = re.compile(r"^[^\S\n]*(?:\d{1,4}[^\S\n]+)?(?:[^\W\d_][^\S\n]+){5,}[^\W\d_](?:[^\S\n]*\|?[^\S\n]*\d{1,4})?[^\S\n]*$\n?", re.M)
_MARK = re.compile(r"^[^\S\n]*(?:[-*+•▪◦□‣●○–—][^\S\n]+(?!\d+[^\S\n]+-)\S|\(?(?:\d{1,3}[.)][^\S\n]+\S|[A-Za-z][.)][^\S\n]+(?!\d)\S)|[A-ZÀ-Þ][a-zß-ÿ]+ \d{1,3}[:)][^\S\n]+\S)", re.M)
_LEAD = re.compile(r"\s*((?:[A-ZÀ-Þ][a-zß-ÿ\u0300-\u036f]+(?:[^\S\n]*\([^)\n]*\))?[\s|.—/-]+)*)")
_LEAD_WORD = re.compile(r"[^\W\d_]{2,}")

# classes of a code point, as bits
_SPACE, _LETTER, _DIGIT, _VOWEL, _COMMA, _STOP, _CLOSE, _MARKED, _ASCII, _LOWER = (1 << i for i in range(10))


def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or (0x2FA20 <= c < 0xE0000) or c >= 0xE0200:
            continue
        ch = chr(c)
        kind = unicodedata.category(ch)
        if ch.isspace():
            table[c] |= _SPACE
        elif kind[0] == "L":
            table[c] |= _LETTER | (_ASCII if c < 128 else 0) | (_LOWER if kind == "Ll" else 0)
        elif kind[0] == "N":
            table[c] |= _DIGIT
        elif kind[0] == "M":
            table[c] |= _MARKED
    for chars, bit in (("aeiouyAEIOUY", _VOWEL), (",;", _COMMA), (".!?…", _STOP), ("\"'”’»)", _CLOSE)):
        for ch in chars:
            table[ord(ch)] |= bit
    return table


_TABLE: list[np.ndarray] = []


def _packed(words: tuple[str, ...]) -> np.ndarray:
    return np.sort(np.array([int.from_bytes(w.encode().ljust(8, b"\0"), "little") for w in words], np.uint64))


_COMMON = _packed(COMMON_WORDS)
_NAN = float("nan")


def _body(text: str) -> str:
    if "<<<HEADING:" in text:
        text = _HEADING.sub("", text)
    return _SPACED.sub("", text)


def measure(texts: list[str]) -> np.ndarray:
    """Statistics of every text, a row each, in the order of ``STATISTICS``; nan where there is none.

    Counts are taken over the code points of all texts at once, with array operations.
    """
    if not _TABLE:
        _TABLE.append(_classes())
    bodies = [_body(t) for t in texts]
    n = len(bodies)
    joined = np.frombuffer(("\n".join(bodies) + "\n").encode("utf-32-le", "replace"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, n))])
    kind = _TABLE[0][np.minimum(joined, 0x10FFFF)]

    def totals(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return c[bounds[1:]] - c[bounds[:-1]]

    def per_text(positions: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(np.searchsorted(bounds, positions, "right") - 1, weights=weights, minlength=n)[:n]

    space = (kind & _SPACE) > 0
    letter, digit = (kind & _LETTER) > 0, (kind & _DIGIT) > 0
    alnum = letter | digit | ((kind & _MARKED) > 0)
    ink = totals(~space)
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    size = ends - starts

    def within(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return c[ends] - c[starts]

    letters, digits, plain = within(letter), within(digit), within((kind & _ASCII) > 0)
    is_word = letters + digits > 0
    words = per_text(starts[is_word])
    tokens = per_text(starts)
    short = per_text(starts[size == 1])
    # runs of one letter don't make a word
    same = np.concatenate([[False, False], (joined[2:] == joined[1:-1]) & (joined[1:-1] == joined[:-2])])
    like = (letters >= 3) & (letters <= 18) & (plain == letters) & (digits == 0) & (size - letters <= 2) & (within((kind & _VOWEL) > 0) > 0) & (within(same & letter) == 0)
    word_like = per_text(starts[like])
    # common words: runs of letters of up to eight, packed into a number
    edge = np.concatenate([[False], alnum, [False]])
    a, b = np.flatnonzero(edge[1:-1] & ~edge[:-2]), np.flatnonzero(edge[1:-1] & ~edge[2:]) + 1
    brief = b - a <= 8
    a, b = a[brief], b[brief]
    code = np.zeros(len(a), np.uint64)
    low = np.where((joined >= 65) & (joined <= 90), joined + 32, np.minimum(joined, 255)).astype(np.uint64)
    for i in range(8):
        has = a + i < b
        code[has] |= low[a[has] + i] << np.uint64(8 * i)
    common = per_text(a[_COMMON[np.minimum(np.searchsorted(_COMMON, code), len(_COMMON) - 1)] == code])
    # lines with ink; the last character that isn't a space or a closing mark tells how a line ends
    line_end = np.flatnonzero(joined == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    inked = np.concatenate([[0], np.cumsum(~space, dtype=np.int32)])
    full = inked[line_end] > inked[line_start]
    last = np.maximum.accumulate(np.where(~space & ((kind & _CLOSE) == 0), np.arange(len(joined)), -1))
    stop = full & (last[line_end] >= line_start) & ((kind[np.maximum(last[line_end], 0)] & _STOP) > 0)
    lines, stops = per_text(line_start[full]), per_text(line_start[stop])
    # a line that goes on from the one before starts with a small letter that isn't a mark
    first = starts[np.searchsorted(starts, line_start[full])]
    after = joined[np.minimum(first + 1, len(joined) - 1)]
    goes_on = ((kind[first] & _LOWER) > 0) & (after != ord(")")) & (after != ord("."))
    continued = per_text(line_start[full][goes_on])
    marks = np.fromiter((len(_MARK.findall(t)) for t in bodies), np.int64, n)
    lead = np.fromiter((len(_LEAD_WORD.findall(_LEAD.match(t).group(1))) for t in bodies), np.int64, n)
    signs = ink - totals(alnum)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.column_stack([
            words, totals(alnum) / words, signs / ink, stops / lines, np.where(words > 0, common / np.maximum(words, 1), np.where(ink > 0, 0.0, _NAN)), words / lines,
            marks / np.maximum(lines - continued, 1), continued / lines, totals(digit) / ink, short / tokens, word_like / tokens, np.where(ink > 0, lead, _NAN), totals((kind & _COMMA) > 0) / tokens,
        ])
    out[~np.isfinite(out)] = _NAN
    out[lines == 0, STATISTICS.index("marked_lines")] = _NAN
    return out


_RESULT = "struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">"


def statistics(df: DataFrame, text: str = "text", chunk: int = 100_000) -> DataFrame:
    """``df`` with a column for each name in ``STATISTICS``, measured ``chunk`` characters at a time."""
    df, renamed = make_room(df, (*STATISTICS, "_s"))
    text = renamed[text]

    @F.pandas_udf(_RESULT)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found, block, size = [], [], 0
            for t in texts:
                block.append(t or "")
                size += len(block[-1])
                if size >= chunk:
                    found.append(measure(block))
                    block, size = [], 0
            if block:
                found.append(measure(block))
            yield pd.DataFrame(np.concatenate(found) if found else np.zeros((0, len(STATISTICS))), columns=list(STATISTICS))

    # not deterministic: never evaluated a second time below a filter on a statistic
    run = run.asNondeterministic()
    out = df.withColumn("_s", run(F.col(text).cast("string")))
    value = lambda s: F.when(~F.isnan(F.col(f"_s.{s}")), F.col(f"_s.{s}"))
    return out.select(*df.columns, F.coalesce(value("word_count"), F.lit(0.0)).cast("bigint").alias("word_count"), *(value(s).alias(s) for s in STATISTICS[1:]))


@dataclass(frozen=True)
class Condition:
    feature: str
    low: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] <= self.threshold if self.low else x[self.feature] > self.threshold

    def sql(self) -> str:
        return f"{self.feature} {'<=' if self.low else '>'} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    kind: str
    conditions: tuple[Condition, ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(x.values())))
        return reduce(np.logical_and, (c.holds(x) for c in self.conditions), np.ones(n, bool))


def _take(x: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in x.items()}


def _grow(x: dict[str, np.ndarray], y: np.ndarray, kind: str, features: tuple[str, ...], cuts: dict[str, np.ndarray]) -> Rule | None:
    conditions: list[Condition] = []
    rows = np.arange(len(y))
    while True:
        good = y[rows]
        p, n = good.sum(), (~good).sum()
        if n == 0 or p == 0:
            break
        base, best, gain = np.log2(p / (p + n)), None, 1e-9
        for f in features:
            v = x[f][rows]
            order = np.argsort(v, kind="stable")
            sorted_v, sorted_y = v[order], good[order]
            cum_p = np.concatenate([[0], np.cumsum(sorted_y)])
            at = np.searchsorted(sorted_v, cuts[f], side="right")
            for low in (True, False):
                pp = cum_p[at] if low else p - cum_p[at]
                nn = (at - cum_p[at]) if low else n - (at - cum_p[at])
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), 0)
                if not len(g) or g.max() <= gain:
                    continue
                # of equally good thresholds the one in the middle of their range
                tied = cuts[f][g >= g.max() - 1e-9]
                best, gain = Condition(f, low, float((tied[0] + tied[-1]) / 2)), g.max()
        if best is None:
            break
        conditions.append(best)
        rows = rows[best.holds(_take(x, rows))]
    return Rule(kind, tuple(conditions)) if conditions else None


def _prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> tuple[Rule, float]:
    """The prefix of the conditions that is worth most on the pruning rows; ties go to the shorter."""
    best, worth = rule, -2.0
    for k in range(1, len(rule.conditions) + 1):
        part = Rule(rule.kind, rule.conditions[:k])
        hit = y[part.covers(x)]
        p, n = hit.sum(), (~hit).sum()
        w = (p - n) / (p + n) if p + n else -1.0
        if w > worth + 1e-12:
            best, worth = part, w
    return best, worth


def induce(rows: pd.DataFrame, label: str = "kind", kinds: tuple[str, ...] = KINDS, features: tuple[str, ...] = RULE_STATISTICS) -> list[Rule]:
    """Ordered rules for all kinds but the last, which is the default. The same rows give the same rules."""
    rows = rows[rows[label].isin(kinds)].dropna(subset=list(features)).reset_index(drop=True)
    rules: list[Rule] = []
    if rows.empty:
        return rules
    x = {f: rows[f].to_numpy(float) for f in features}
    cuts = {}
    for f in features:
        values = np.unique(x[f])
        cuts[f] = (values[1:] + values[:-1]) / 2
    kind = rows[label].to_numpy()
    part = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), bool)
    present = [k for k in kinds[:-1] if (kind == k).any()]
    for k in present:
        while True:
            y = kind == k
            grow, prune = np.flatnonzero(left & ~part), np.flatnonzero(left & part)
            if not y[grow].any():
                break
            rule = _grow(_take(x, grow), y[grow], k, features, cuts)
            if rule is None:
                break
            worth = 0.0
            if y[prune].any():
                rule, worth = _prune(rule, _take(x, prune), y[prune])
            else:
                hit = y[grow][rule.covers(_take(x, grow))]
                worth = 2 * hit.mean() - 1 if len(hit) else -1.0
            covered = rule.covers(x) & left
            if worth <= 0 or not covered.any():
                break
            rules.append(rule)
            left &= ~covered
    return rules


def case_sql(rules: list[Rule], default: str = KINDS[-1]) -> str:
    """The rule list as a SQL CASE expression over the statistics; null where there is no text."""
    whens = "".join(f" WHEN {' AND '.join(c.sql() for c in r.conditions)} THEN '{r.kind}'" for r in rules)
    return f"CASE WHEN symbol_ratio IS NULL THEN NULL{whens} ELSE '{default}' END"


def kind_of(rules: list[Rule]) -> Column:
    return F.expr(case_sql(rules))


def labelled_sample(labels: DataFrame, keys: list[str], max_labels: int = 20_000) -> DataFrame:
    """At most ``max_labels`` labelled keys, by a hash of the key; keys with two kinds are left out."""
    one = labels.where(" and ".join(f"{k} is not null" for k in [*keys, "kind"])).groupBy(*keys).agg(F.min("kind").alias("kind"), F.max("kind").alias("_other")).where("kind = _other").drop("_other")
    return one.orderBy(F.xxhash64(*keys), *keys).limit(max_labels)


def learn(items: DataFrame, labels: DataFrame, keys: list[str], text: str = "text", max_labels: int = 20_000) -> list[Rule]:
    """Rules from the labelled items. ``items`` holds keys and text, labels keys and kind."""
    # at most max_labels keys: small enough to send to every task, so no text is shuffled
    sample = labelled_sample(labels, keys, max_labels)
    # of several texts under one key the first in order counts, so that the same rows give the same rules
    labelled = items.select(*keys, text).join(F.broadcast(sample), keys).groupBy(*keys, "kind").agg(F.min(text).alias(text))
    rows = statistics(labelled, text).drop(text).toPandas()
    if rows.empty:
        return []
    order = pd.util.hash_pandas_object(rows[keys].astype(str).agg("|".join, axis=1), index=False)
    return induce(rows.assign(_h=order.to_numpy()).sort_values("_h", kind="stable").reset_index(drop=True))


def agree(kinds: DataFrame, parts: DataFrame, group: str, whole: str, part: str) -> DataFrame:
    """One kind for all texts of a whole, by vote of its parts and of the whole itself.

    ``kinds`` is (group, item, kind), ``parts`` tells which items (``part``) stand in which item
    (``whole``). Of kinds with as many votes the one of the whole's own text counts, then the first by
    name. Items that stand in no whole keep their kind. Only keys and kinds are shuffled, and votes are
    counted before they are.
    """
    inside = parts.select(F.col(group).alias("g"), F.col(whole).alias("w"), F.col(part).alias("p")).where("g is not null and w is not null and p is not null").distinct()
    one = kinds.select(F.col(group).alias("g"), F.col("item").alias("i"), "kind").where("kind is not null").distinct()
    own = one.join(inside.select("g", F.col("w").alias("i")).distinct(), ["g", "i"], "left_semi").select("g", F.col("i").alias("w"), "kind", F.lit(1).alias("n"), F.lit(1).alias("own"))
    votes = inside.join(one.withColumnRenamed("i", "p"), ["g", "p"]).groupBy("g", "w", "kind").agg(F.count("*").cast("int").alias("n")).withColumn("own", F.lit(0))
    counted = votes.unionByName(own).groupBy("g", "w", "kind").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
    winner = counted.groupBy("g", "w").agg(F.max_by("kind", F.struct("n", "own", "kind")).alias("said"))
    told = winner.withColumnRenamed("w", "i").unionByName(inside.join(winner, ["g", "w"]).select("g", F.col("p").alias("i"), "said")).groupBy("g", "i").agg(F.min("said").alias("said"))
    out = one.join(told, ["g", "i"], "left")
    return out.select(F.col("g").alias(group), F.col("i").alias("item"), F.coalesce("said", "kind").alias("kind")).distinct()
