"""Noise in text from scanned pages (problem 4).

A first pass over all texts counts words and pairs of neighbouring words. The frequent words are the
vocabulary: a trie. A second pass repairs every text by itself: running heads and page numbers go,
words cut at line ends are joined, misread words are corrected, and lines are reflowed to paragraphs.

A Levenshtein automaton of a printed word is intersected with the trie, which yields every vocabulary
word within reach. It is weighted: first come the confusions of scanning (one letter or two read as one or
two others, and any letter for a sign or digit between letters), up to ``max_edits`` of them; where none
leads to a word, plain substitutions, insertions and deletions are tried, up to ``plain_edits``.

Which of the candidates a place had, if any, is decided by counts and context. A candidate must be
``ratio`` times as frequent as the printed word itself, so that a rare word stands unless it looks like a
misreading. A word of letters only must also fit: of its neighbours that are vocabulary words one at least
stands beside the candidate elsewhere, and none stands beside the printed word nearly as often. A
plain edit needs all of them. So ``modem`` stays beside ``modern`` where the words around it say so.

What is sent to the tasks is bounded by shares of all words, whatever the size of the corpus: the
words of the trie, at most ``1 / share``; counts of words by their hashes, at most ``1 / known_share``; counts
of pairs by their hashes, at most ``1 / pair_share``. Words below ``known_share`` count as unseen: they are
corrected only as context allows, and are joined when cut only if they are misread forms of others.

Defined results: null texts give null and no noise, blank ones stay; a text that is junk by the rules
of problem 5 has no noise and stays; a null page has no page number, a missing head no header; rows
that come again are treated again; other columns are carried, one with the name of an added column as
``<name>_input``. Whole texts are read.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.looks import canonical
from pagemill.llm.naming import make_room
from pagemill.llm.quality import KINDS, STATISTICS, Rule, measure
from pagemill.session import materialize

NOISES = ("hyphen", "misread", "header", "pageno")

# What scanning makes of letters, as (true, printed).
CONFUSIONS = (
    ("a", "@"), ("b", "6"), ("b", "8"), ("d", "cl"), ("e", "c"), ("g", "9"), ("g", "q"), ("h", "b"), ("h", "li"), ("i", "1"), ("i", "l"), ("i", "!"), ("i", "|"), ("l", "1"), ("l", "i"), ("l", "|"), ("m", "rn"), ("m", "nn"),
    ("n", "ri"), ("n", "ii"), ("o", "0"), ("s", "5"), ("s", "$"), ("t", "1"), ("t", "f"), ("u", "ii"), ("w", "vv"), ("y", "v"), ("z", "2"), ("in", "m"), ("rn", "m"), ("cl", "d"), ("ri", "n"), ("li", "h"), ("vv", "w"),
)

_TOKEN = re.compile(r"[^\W_]*[@$|!](?=[^\W_])[^\W_]+|[^\W_]+(?:[@$|!](?=[^\W_])[^\W_]+)*")
_VALUE = re.compile(r"\d+(?:st|nd|rd|th)?|\d*d\d+|\d+[a-z]|[0-9a-f]{16,}")
_WORD = re.compile(r"[^\W\d_]{2,}")
_PAIRS = re.compile(r"[^\W\d_]+|\d+")
#: a word cut at a line end, which may have become a space
_CUT_END = re.compile(r"[-‐‑¬­]\s")
_CUT = re.compile(r"([^\W\d_][\w@$]*|[\w@$]*[^\W\d_])([-‐‑¬­])(\s+)([\w@$]*[^\W\d_][\w@$]*)")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


class Counts:
    """Counts by 64-bit hashes of what is counted: 12 bytes an entry."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.n = hashes[order], n[order]
        self.memo: dict[str, int] = {}

    @classmethod
    def of(cls, counts: dict[str, int]) -> Counts:
        return cls(np.array([_hash(k) for k in counts], np.uint64), np.array([*counts.values()], np.uint32))

    def __getstate__(self) -> tuple:
        return self.hashes, self.n

    def __setstate__(self, state: tuple) -> None:
        self.hashes, self.n = state
        self.memo = {}

    def get(self, key: str) -> int:
        found = self.memo.get(key)
        if found is None:
            h = np.uint64(_hash(key))
            i = int(np.searchsorted(self.hashes, h))
            found = int(self.n[i]) if i < len(self.hashes) and self.hashes[i] == h else 0
            if len(self.memo) < 300_000:
                self.memo[key] = found
        return found


@dataclass
class Lexicon:
    """Vocabulary with counts, as a trie; counts of all words that are known, and of neighbouring words."""

    counts: dict[str, int]
    pairs: Counts | dict[tuple[str, str], int]
    known: Counts | None = None
    max_edits: int = 2
    plain_edits: int = 1
    #: Words of the trie have as many occurrences at least.
    least: int = 5
    ratio: int = 20

    def __post_init__(self) -> None:
        if isinstance(self.pairs, dict):
            self.pairs = Counts.of({f"{a} {b}": n for (a, b), n in self.pairs.items()})
        self._begin()

    def _begin(self) -> None:
        self.trie: dict = {}
        self.memo: dict[str, list[tuple[int, str]]] = {}
        self.plain_memo: dict[str, list[str]] = {}
        self.doubt: dict[str, int] = {}
        self.pieces: set[str] = set()
        self.printed: dict[str, list[tuple[str, str]]] = {}
        for true, printed in CONFUSIONS:
            self.printed.setdefault(printed[0], []).append((printed, true))
        for w, n in self.counts.items():
            if n >= self.least:
                node = self.trie
                for ch in w:
                    node = node.setdefault(ch, {})
                node[""] = n

    def __getstate__(self) -> tuple:
        return self.counts, self.pairs, self.known, self.max_edits, self.plain_edits, self.least, self.ratio

    def __setstate__(self, state: tuple) -> None:
        self.counts, self.pairs, self.known, self.max_edits, self.plain_edits, self.least, self.ratio = state
        self._begin()

    def seen(self, word: str) -> int:
        """How often a word stands in the corpus; 0 if too rare to be known."""
        return self.counts.get(word) or (self.known.get(word) if self.known else 0)

    def pair(self, a: str, b: str) -> int:
        return self.pairs.get(f"{a} {b}")

    def candidates(self, word: str) -> list[tuple[int, str]]:
        """(edits, vocabulary word) of all words that turn into ``word`` by confusions, itself excluded.

        A state is a node of the trie and a place in the printed word with the edits so far; each letter of
        the printed word is read as it is or by a confusion.
        """
        found = self.memo.get(word)
        if found is None:
            best: dict[str, int] = {}
            mixed = not word.isalpha()
            n = len(word)
            stack = [(self.trie, 0, 0, "")]
            while stack:
                node, i, edits, prefix = stack.pop()
                if i == n:
                    if "" in node and prefix != word and edits < best.get(prefix, 10**6):
                        best[prefix] = edits
                    continue
                ch = word[i]
                if (down := node.get(ch)) is not None:
                    stack.append((down, i + 1, edits, prefix + ch))
                if edits >= self.max_edits:
                    continue
                for printed, true in self.printed.get(ch, ()):
                    if word.startswith(printed, i):
                        down = node
                        for c in true:
                            down = down.get(c)
                            if down is None:
                                break
                        else:
                            stack.append((down, i + len(printed), edits + 1, prefix + true))
                if mixed and not ch.isalpha():
                    # a sign in a word may stand for any letter
                    stack += [(down, i + 1, edits + 1, prefix + c) for c, down in node.items() if c]
            found = sorted((e, w) for w, e in best.items())
            if len(self.memo) < 300_000:
                self.memo[word] = found
        return found

    def plain_candidates(self, word: str) -> list[str]:
        """All vocabulary words within ``plain_edits`` substitutions, insertions and deletions, itself excluded."""
        found = self.plain_memo.get(word)
        if found is None:
            best: set[str] = set()
            n = len(word)
            stack = [(self.trie, 0, 0, "")]
            while stack:
                node, i, edits, prefix = stack.pop()
                if "" in node and n - i <= self.plain_edits - edits and prefix != word:
                    best.add(prefix)
                if i < n and (down := node.get(word[i])) is not None:
                    stack.append((down, i + 1, edits, prefix + word[i]))
                if edits < self.plain_edits:
                    for c, down in node.items():
                        if c:
                            stack.append((down, i, edits + 1, prefix + c))
                            if i < n and c != word[i]:
                                stack.append((down, i + 1, edits + 1, prefix + c))
                    if i < n:
                        stack.append((node, i + 1, edits + 1, prefix))
            found = sorted(best)
            if len(self.plain_memo) < 300_000:
                self.plain_memo[word] = found
        return found

    def doubtful(self, word: str) -> int:
        """0: the printed word stands. 1: a far more frequent one is a confusion away. 2: it isn't known, and plain edits may be tried."""
        found = self.doubt.get(word)
        if found is None:
            low = word.lower()
            found = 0
            if len(low) > 1 and not _VALUE.fullmatch(low) and any(c.isalpha() for c in low):
                own = self.seen(low)
                if any(self.counts[c] >= self.ratio * own for _, c in self.candidates(low)):
                    found = 1
                elif self.plain_edits and low not in self.counts and len(low) > 3 and word == low and low.isalpha():
                    found = 2
            if len(self.doubt) < 500_000:
                self.doubt[word] = found
        return found

    def odd(self, text: str) -> list[str]:
        """The stretches without white space that hold any word in doubt, each once."""
        found = []
        for piece in set(text.split()) - self.pieces:
            if any(self.doubtful(w) for w in _TOKEN.findall(piece)):
                found.append(piece)
            elif len(self.pieces) < 500_000:
                self.pieces.add(piece)
        return found

    def fits(self, candidate: str, word: str, before: str, after: str, sure: bool = False) -> bool:
        """Whether the neighbours that are vocabulary words speak for the candidate and not for the printed word.

        To be ``sure``, each of them, numbers too, must stand beside the candidate ``ratio`` times as often as beside the
        printed word, and five times in all.
        """
        said = lambda w: w in self.counts or sure and w == "#"
        beside = [((before, candidate), (before, word))] if said(before) else []
        beside += [((candidate, after), (word, after))] if said(after) else []
        votes = [(self.pair(*c), self.pair(*w)) for c, w in beside]
        if sure:
            return sum(c for c, _ in votes) >= 5 and all(c >= max(1, self.ratio * w) for c, w in votes)
        if any(w > 1 and c < 4 * w for c, w in votes):
            return False
        return not votes or any(c for c, _ in votes)

    def correct(self, word: str, before: str = "", after: str = "") -> str | None:
        """The word a printed one (lower case) was, or None if it stands or nothing near fits."""
        if not self.doubtful(word):
            return None
        own = self.seen(word)
        mixed = not word.isalpha()
        near = [(e, c) for e, c in self.candidates(word) if self.counts[c] >= self.ratio * own and (mixed or self.fits(c, word, before, after))]
        if near:
            least = near[0][0]
            return max((c for e, c in near if e == least), key=lambda c: (self.pair(before, c) + self.pair(c, after), self.counts[c], c))
        if mixed or not self.plain_edits or word in self.counts or not (before in self.counts or after in self.counts):
            return None
        far = [c for c in self.plain_candidates(word) if self.counts[c] >= self.ratio * max(own, 1) and self.fits(c, word, before, after, sure=True)]
        return max(far, key=lambda c: (self.pair(before, c) + self.pair(c, after), self.counts[c], c), default=None)


def count_batches(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Partial counts: (w, h, n), a word and its hash, or null and the hash of two neighbouring words. Numbers count as ``#``.

    What stands between white space is numbered, counted as numbers, and taken apart once for each kind.
    """
    ids: dict[str, int] = {}
    row: list[int] = []  # the texts as numbers, 0 between them

    def flush() -> pa.RecordBatch:
        found = [[], *(["#" if x[0].isdigit() else x for x in _PAIRS.findall(piece.lower())] for piece in ids)]
        words: Counter[str] = Counter()
        pairs: Counter[tuple[str, str]] = Counter()
        every = np.array(row, np.int64)
        for i, n in enumerate(np.bincount(every, minlength=len(found)).tolist()):
            for x in found[i]:
                words[x] += n
            for x in zip(found[i], found[i][1:], strict=False):
                pairs[x] += n
        code, n = np.unique(every[:-1] << 32 | every[1:], return_counts=True) if len(every) else (every, every)
        for x, y, k in zip((code >> 32).tolist(), (code & 0xFFFFFFFF).tolist(), n.tolist(), strict=True):
            if found[x] and found[y]:
                pairs[found[x][-1], found[y][0]] += k
        w = [*words, *[None] * len(pairs)]
        h = np.fromiter((_hash(x) for x in (*words, *(f"{a} {b}" for a, b in pairs))), np.uint64, len(w)).view(np.int64)
        ids.clear()
        row.clear()
        return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(h), pa.array([*words.values(), *pairs.values()], pa.int64())], names=["w", "h", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text is None:
                continue
            pieces = text.split()
            try:
                row.extend(list(map(ids.__getitem__, pieces)))
            except KeyError:
                for piece in pieces:
                    row.append(ids.setdefault(piece, len(ids) + 1))
            row.append(0)
            if len(row) > most:
                yield flush()
    yield flush()


def build_lexicon(texts: DataFrame, text: str = "text", share: float = 1e-5, known_share: float = 1e-7, pair_share: float = 2e-7, plain_edits: int = 1) -> Lexicon:
    """Vocabulary, known words and pairs of a whole corpus, each bounded by its share."""
    counted = texts.select(F.col(text).cast("string").alias("t")).mapInArrow(count_batches, "w string, h bigint, n bigint")
    total_of = counted.groupBy("w", "h").agg(F.sum("n").alias("n"))
    # the bounds need the total of all words, so the counts are read more than once and made once
    every = materialize(total_of.where("n >= 2"), "lexicon")
    total = every.where("w is not null").agg(F.sum("n")).first()[0] or 0
    word = F.col("w").isNotNull()
    often = lambda least, of: F.col("n") >= max(least, of * total)
    kept = every.where((word & often(2, known_share)) | (~word & often(2, pair_share)))
    rows = kept.select(F.when(often(3, share), F.col("w")).alias("w"), word.alias("word"), "h", F.least("n", F.lit(2**32 - 1)).alias("n")).toArrow()
    words = {w: n for w, n in zip(rows.column("w").to_pylist(), rows.column("n").to_pylist(), strict=True) if w is not None and _WORD.fullmatch(w)}
    hashes, n, is_word = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy().astype(np.uint32), rows.column("word").to_numpy()
    return Lexicon(words, Counts(hashes[~is_word], n[~is_word]), Counts(hashes[is_word], n[is_word]), plain_edits=plain_edits, least=max(5, int(3 * share * total)))


_FOLDED: dict[str, str] = {}


def _fold(text: str) -> tuple[str, list[int]]:
    """Letters and digits in lower case without accents, and where they stand."""
    out, at = [], []
    for i, ch in enumerate(text):
        folded = _FOLDED.get(ch)
        if folded is None:
            folded = "".join(c for c in unicodedata.normalize("NFD", ch.lower()) if c.isalnum()) if ch.isalnum() else ""
            _FOLDED[ch] = folded
        for c in folded:
            out.append(c)
            at.append(i)
    return "".join(out), at


class Head:
    """A title as it may be printed as running head."""

    def __init__(self, title: str) -> None:
        self.key = _fold(title)[0]
        self.short = len(self.key) < 6
        # a short title that differs in capitals from the same word in running text
        self.shouted = len(self.key) > 2 and not title.isupper()
        last = re.findall(r"\w+", title.lower())[-1:] or [""]
        self.hints = (last[0], " ".join(last[0]), _fold(last[0])[0])


_SEPARATORS = re.compile(r"[\s\d|·•.,:;–—\-\[\]()]*")
# words after which, and signs before which, a title is spoken of and not printed as running head
_SPOKEN_BEFORE = re.compile(r"(?:\b(?:see|also|in|from|to|of|called|titled|named|book|and|or|with|the|read|consult|per)|[“\"'(‘,:])\s*$", re.I)
_SPOKEN_AFTER = re.compile(r"\s*[,.;!?)”\"’]")


def find_heads(text: str, heads: list[Head]) -> list[tuple[int, int]]:
    """Spans of running heads in a text of one form.

    Titles of fewer than six letters or digits are words of the running text too: they count alone on a
    line, beside another head, or in capitals if the title isn't; those of digits only don't count.
    """
    low = text.lower()
    spans, short = [], {}
    for h in heads:
        if not h.key or h.short and h.key.isdigit():
            continue
        for hint in {x for x in h.hints if x}:
            p = low.find(hint)
            while p >= 0:
                # the head ends at the hint; set with spaces it takes up to four places a letter
                first = max(0, p - 4 * len(h.key) - 40)
                folded, at = _fold(text[first : p + len(hint) + 20])
                start = folded.find(h.key)
                while start >= 0:
                    a, b = first + at[start], first + at[start + len(h.key) - 1] + 1
                    while b < len(text) and unicodedata.combining(text[b]):
                        b += 1
                    if (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum()):
                        spans.append((a, b))
                        if h.short:
                            short[a, b] = h.shouted
                    start = folded.find(h.key, start + 1)
                p = low.find(hint, p + 1)
    if not spans:
        return []
    spans = sorted(set(spans))
    out = []
    for i, (a, b) in enumerate(spans):
        line_a, line_b = text.rfind("\n", 0, a) + 1, text.find("\n", b)
        line_b = len(text) if line_b < 0 else line_b
        rest_before, rest_after = text[line_a:a], text[b:line_b]
        for x, y in spans:  # another head on the same line is no running text
            if line_a <= x < y <= a:
                rest_before = rest_before.replace(text[x:y], "")
            if b <= x < y <= line_b:
                rest_after = rest_after.replace(text[x:y], "")
        found = text[a:b]
        if not found[0].isupper() and not found[0].isdigit():
            continue
        spaced = bool(re.match(r"\w\s+\w\s+\w\s", found))
        if _SEPARATORS.fullmatch(rest_before) and _SEPARATORS.fullmatch(rest_after):
            out.append((a, b))
        elif spaced or (found.isupper() and not _upper(rest_before + rest_after) and short.get((a, b), True)):
            out.append((a, b))
        elif (a, b) in short:
            if any(y <= a and _SEPARATORS.fullmatch(text[y:a]) or b <= x and _SEPARATORS.fullmatch(text[b:x]) for x, y in spans if (x, y) not in short):
                out.append((a, b))
        else:
            joined_to = any(y <= a and _SEPARATORS.fullmatch(text[y:a]) for x, y in spans[:i])
            if joined_to or not (_SPOKEN_BEFORE.search(rest_before) or _SPOKEN_AFTER.match(rest_after)):
                out.append((a, b))
    return out


def _upper(text: str) -> bool:
    letters = [c for c in text if c.isalpha()]
    return bool(letters) and sum(c.isupper() for c in letters) > 0.8 * len(letters)


_NUMBERS: dict[int, tuple[re.Pattern, ...]] = {}


def _number_patterns(page: int) -> tuple[re.Pattern, ...]:
    """Patterns of a page's number, compiled once: marked, barred, before and after a head, and alone."""
    found = _NUMBERS.get(page)
    if found is None:
        n = re.escape(str(page))
        found = (
            re.compile(rf"(?<![\w.])(?:[Pp]age|PAGE|[Pp]\.|P\.) {n}(?!\w)|\[{n}\]|(?:^|(?<=\s))[-–—] {n} [-–—](?=\s|$)", re.M),
            re.compile(rf"(?:^|(?<=\s)){n} \|(?=\s|$)|(?:^|(?<=\s))\| {n}(?=\s|$)", re.M),
            re.compile(rf"(?<!\w){n}[ \t|·–—-]*$"),
            re.compile(rf"[ \t|·–—-]*{n}(?![\w.])"),
            re.compile(rf"^[^\S\n]*{n}[^\S\n]*$", re.M),
        )
        if len(_NUMBERS) > 5_000:
            _NUMBERS.clear()
        _NUMBERS[page] = found
    return found


def _part_of_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def find_page_numbers(text: str, page: int | None, heads: list[tuple[int, int]], lexicon: Lexicon, running: bool) -> list[tuple[int, int]]:
    """Spans of the block's own page number printed as page number.

    The signs beside the number's places tell which patterns can match at all.
    """
    if page is None:
        return []
    n = str(page)
    edge = mark = bar = False
    between: list[int] = []  # places with white space, or nothing, on both sides
    a = text.find(n)
    while a >= 0:
        b = a + len(n)
        before, after = text[a - 1] if a else "", text[b : b + 1]
        if not (_part_of_word(before) and _part_of_word(after)):
            edge = True
            if before == "[" or before == " " and a > 1 and text[a - 2] in "eE.-–—":
                mark = True
            if after == " " and text[b + 1 : b + 2] == "|" or before == " " and a > 1 and text[a - 2] == "|":
                bar = True
            if (not before or before.isspace()) and (not after or after.isspace()):
                between.append(a)
        a = text.find(n, a + 1)
    if not edge:
        return []
    marked, barred, before_head, after_head, alone = _number_patterns(page)
    out = [m.span() for m in marked.finditer(text)] if mark else []
    if running and bar:
        # the number with a bar, at the start of a line or between words
        out += [m.span() for m in barred.finditer(text)]
    for a, b in heads:
        if before := before_head.search(text[:a]):
            out.append((before.start(), a))
        if after := after_head.match(text[b:]):
            out.append((b, b + after.end()))
    if running and between:
        out += [m.span() for m in alone.finditer(text) if not re.search(r":\s*$", text[: m.start()])]
        out += [(a, a + len(n)) for a in between if 0 < a < len(text) - len(n) and _loose(text, a, a + len(n), lexicon)]
    return _disjoint(out)


def _loose(text: str, a: int, b: int, lexicon: Lexicon) -> bool:
    """Whether a bare number stands between words that go together without it."""
    before, after = re.search(r"([^\W\d_]+)\s+$", text[max(0, a - 40) : a]), re.match(r"\s+([^\W\d_]+)", text[b : b + 40])
    if not before or not after:
        return False
    x, y = before.group(1).lower(), after.group(1).lower()
    together = lexicon.pair(x, y)
    with_number = min(lexicon.pair(x, "#"), lexicon.pair("#", y))
    return together >= 5 and together > 20 * with_number


def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """Text without the furniture; a line of nothing else goes whole, and words don't run together."""
    if not spans:
        return text
    out, done = [], 0
    for a, b in _disjoint(spans):
        left, right = text[done:a].rstrip(" \t|·"), text[b:]
        out.append(left)
        gap = len(right) - len(right.lstrip(" \t|·"))
        done = b + gap
        at_line_start = not left or left.endswith("\n")
        if at_line_start and text[done : done + 1] == "\n":
            done += 1
        elif not at_line_start and text[done : done + 1] not in ("", "\n"):
            out.append(" ")
    out.append(text[done:])
    return "".join(out).strip("\n") if spans and spans[0][0] == 0 else "".join(out)


def join_cut_words(text: str, lexicon: Lexicon) -> tuple[str, int]:
    """Text with words cut at line ends joined, and their number."""
    n = 0

    def join(m: re.Match) -> str:
        nonlocal n
        left, _, _, right = m.groups()
        if right[0].isupper() and not left[-1].isupper():
            return m.group()
        word = (left + right).lower()
        if word in lexicon.counts or lexicon.seen(word) >= 3 or lexicon.candidates(word):
            n += 1
            return left + right
        return m.group()

    return (_CUT.sub(join, text) if _CUT_END.search(text) else text), n


_WORD_BEFORE, _WORD_AFTER = re.compile(r"([^\W_]+)\W+$"), re.compile(r"\W+([^\W_]+)")


def _beside(text: str, a: int, b: int) -> tuple[str, str]:
    """The words before and after a place, numbers as ``#``."""
    before, after = _WORD_BEFORE.search(text[max(0, a - 40) : a]), _WORD_AFTER.match(text, b)
    found = (m.group(1).lower() if m else "" for m in (before, after))
    return tuple("#" if w[:1].isdigit() else w for w in found)


def correct_words(text: str, lexicon: Lexicon) -> tuple[str, int]:
    """Text with misread words corrected, and their number."""
    odd = lexicon.odd(text)
    if not odd:
        return text, 0
    n = 0
    places = []
    for piece in odd:
        a = text.find(piece)
        while a >= 0:
            b = a + len(piece)
            if (not a or text[a - 1].isspace()) and (b == len(text) or text[b].isspace()):
                places += [(a + m.start(), m.group()) for m in _TOKEN.finditer(piece)]
            a = text.find(piece, b)
    out, done = [], 0
    for a, word in sorted(places):
        if not lexicon.doubtful(word):
            continue
        right = lexicon.correct(word.lower(), *_beside(text, a, a + len(word)))
        if right is None:
            continue
        n += 1
        letters = [c for c in word if c.isalpha()]
        if len(letters) > 1 and all(c.isupper() for c in letters):
            right = right.upper()
        elif word[0].isupper():
            right = right.capitalize()
        out += [text[done:a], right]
        done = a + len(word)
    return "".join([*out, text[done:]]), n


def reflow(text: str) -> str:
    """Wrapped lines of a paragraph in one line; blank lines part paragraphs."""
    paragraphs = [" ".join(x.split()) for x in re.split(r"\n\s*\n", text)]
    return "\n\n".join(p for p in paragraphs if p)


def kinds_of(texts: list[str], rules: list[Rule], chunk: int = 100_000) -> list[str]:
    """Kind of every text by the rules, measured many at a time."""
    out: list[str] = []
    block: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        block.append(t)
        size += len(t)
        if size >= chunk or i == len(texts) - 1:
            columns = measure(block)
            x = {s: columns[:, k] for k, s in enumerate(STATISTICS)}
            kind = np.full(len(block), KINDS[-1], object)
            for r in reversed(rules):
                kind[r.covers(x)] = r.kind
            out += kind.tolist()
            block, size = [], 0
    return out


def repair(text: str | None, pages: list[int], heads: list[Head], lexicon: Lexicon, kind: str, reflowed: bool = True) -> tuple[str | None, list[str]]:
    """The repaired text and the kinds of noise that were in it."""
    if text is None or kind == "junk" or not text.strip():
        return text, []
    # soft hyphens at line ends cut words; elsewhere the one form drops them
    marked = re.sub("­(?=[^\\S\\n]*\\s)", "¬", text) if "­" in text else text
    form = canonical(marked)
    spans = find_heads(form, heads)
    numbers = [x for page in pages for x in find_page_numbers(form, page, spans, lexicon, kind == "prose")]
    joined, cut = join_cut_words(_without(form, [*spans, *numbers]), lexicon)
    fixed, wrong = correct_words(joined, lexicon)
    noises = [n for n, has in zip(NOISES, (cut, wrong, spans, numbers), strict=True) if has]
    return (reflow(fixed) if reflowed and kind == "prose" else fixed), noises


_BUILT: dict[str, tuple[Lexicon, list[Rule]]] = {}


def repair_texts(df: DataFrame, lexicon: Lexicon, rules: list[Rule], text: str = "text", pages: str = "pages", heads: str = "heads", reflowed: bool = True, kinds: str | None = None) -> DataFrame:
    """``df`` with ``repaired`` and ``noises``. ``pages`` is an array of numbers, ``heads`` of titles.

    ``kinds`` names a column with kinds known already; where it is null the text's own is measured.
    """
    df, renamed = make_room(df, ("repaired", "noises", "_r"))
    text, pages, heads = renamed[text], renamed[pages], renamed[heads]
    known_kind = F.col(renamed[kinds]) if kinds else F.lit(None)
    shared = df.sparkSession.sparkContext.broadcast((lexicon, rules))
    name = uuid.uuid4().hex

    @F.pandas_udf("struct<repaired:string,noises:array<string>>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if name not in _BUILT:  # once in each worker process
            _BUILT.clear()
            _BUILT[name] = shared.value
        words, found_rules = _BUILT[name]
        known: dict[str, Head] = {}

        def head(title: str) -> Head:
            if title not in known:
                if len(known) > 20_000:
                    known.clear()
                known[title] = Head(canonical(title))
            return known[title]

        def kinds_for(asked: list[tuple], said: list) -> list[str]:
            own = iter(kinds_of([t or "" for (t, *_), k in zip(asked, said, strict=True) if not isinstance(k, str)], found_rules))
            return [k if isinstance(k, str) else next(own) for k in said]

        for texts, numbers, titles, said in parts:
            said = said.tolist()
            asked = [
                (t, sorted({int(x) for x in p if x is not None and x == x}) if p is not None else [], [head(x) for x in h if x] if h is not None else [])
                for t, p, h in zip(texts, numbers, titles, strict=True)
            ]
            if reflowed:
                rows = [repair(*x, words, kind, True) for x, kind in zip(asked, kinds_for(asked, said), strict=True)]
            else:
                # prose has every noise the other kinds have, so only texts with some need their kind
                rows = [repair(*x, words, "prose", False) for x in asked]
                noisy = [i for i, (_, noises) in enumerate(rows) if noises]
                for i, kind in zip(noisy, kinds_for([asked[i] for i in noisy], [said[i] for i in noisy]), strict=True):
                    if kind != "prose":
                        rows[i] = repair(*asked[i], words, kind, False)
            yield pd.DataFrame(rows, columns=["repaired", "noises"])

    run = run.asNondeterministic()
    out = df.withColumn("_r", run(F.col(text), F.col(pages), F.col(heads), known_kind.cast("string")))
    return out.select(*df.columns, F.col("_r.repaired").alias("repaired"), F.col("_r.noises").alias("noises"))
