"""Evaluation texts inside training text (problem 7).

Both sides become words in one form: the form of equal looks, lower case, words broken at line ends
joined, marks and punctuation gone. Template canonicalisation replaces numbers, dice, units and names by
typed placeholders, on each side by the rules of the word itself and the word before it, so that neither
the other items nor the other documents change what is a template:

* a number is written in digits, as an ordinal, or in words (one to millions, also joined);
* a unit follows a number and is a unit of measure, a short symbol of one, or a plural;
* a name is written with a capital at its start and is no function word.

There are two templates. In the first every word keeps its place and only numbers and units are
placeholders: it finds quotations in any case of letters, and changed numbers. In the second names are
placeholders too, and a number of several words is one. Windows of ``window`` template words are
hash-joined: each document rolls one hash over each template and looks all of them up among the windows of
the evaluation items. A window with fewer than ``MIN_LITERAL`` other words than placeholders tells
nothing as a template (a table of numbers); the first template looks it up as written, the second doesn't.

Hits in a row on one diagonal are runs. Within a run, words are compared as written, which gives the
literal quotations, and slots are compared for consistency: a run with changed values is a
re-parameterised copy if equal values of the item stay equal in the document and different ones different.

The evaluation set is the stated query side. It is read in blocks of about ``block_words`` words (at most
one item more), so what is sent to the tasks is bounded, and each block passes over all documents once.
Documents are never shuffled; only found pairs leave the tasks. A window that comes several times in
an item stands in the index once, and a document window equal to the one before it isn't looked up again, so
the work for a document is in proportion to its windows and the items they hit.

Defined results: null and blank documents or items, and items shorter than the window, give no rows;
documents that come again with the same id give their rows once (the queries are distinct); an item
found at several places of a document gives one row for each run. Ids keep their types.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.looks import canonical

# Units of measure that aren't told by a plural, and words that begin sentences without being names.
UNITS = ("foot", "feet", "inch", "pace", "mile", "meter", "metre", "hour", "minute", "second", "day", "week", "month", "year", "pound", "ounce", "mark", "coin", "percent", "degree", "liter", "litre", "gram", "dollar", "euro")
SYMBOLS = re.compile(r"[kcdmµ]?(?:m|g|l|b|w|hz)|in|ft|yd|mi|lb|oz|km2|mph|kmh|min|h|hr|sec|kg|gp|sp|cp|xp|hp")
FUNCTION_WORDS = frozenset(
    "a about after all also although an and any are as assume at be because before both but by can consider could do does during each either every few find first for from given had has have he her here his how i if in into is it its "
    "later let many may might more most much my next no nor not now of on once one only or other our outside over she should since so some such suppose than that the their them then there these they this those though through to under "
    "unless until up was we were what when where whether which while who whose why will with within without would you your".split()
)
_UNDER_20 = "one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen"
_NUMBER = re.compile(rf"\d+(?:st|nd|rd|th)?|zero|{_UNDER_20}|(?:twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety)(?:{_UNDER_20})?|(?:{_UNDER_20})?(?:hundred|thousand|million|billion)s?|dozen")
_DICE = re.compile(r"\d*d\d+")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐‑­¬][^\S\n]*\n\s*(?=[^\W\d_])")
_LINE_END = re.compile(r"[-‐‑­¬\u200b-\u200d\u2060\ufeff][^\S\n]*[\n\r\u0085\u2028\u2029]")
_DROP = re.compile(r"[^\w\s]|_")

#: Words of a window that must be no placeholders.
MIN_LITERAL = 3
_BASE = 0x9E3779B97F4A7C15
_IS_NUMBER, _IS_DICE, _UNIT_LIKE, _NAME_LIKE, _EMPTY = 1, 2, 4, 8, 16
_CODES = {kind: np.uint64(xxhash.xxh64_intdigest(f"<{kind}>")) for kind in ("number", "dice", "unit", "name")}
_AS_WRITTEN = np.uint64(xxhash.xxh64_intdigest("as written"))

RUN_COLUMNS = "doc_word int, item_word int, n_words int, literal_words int, slots int, changed int, consistent boolean"


class Words:
    """What is known of every piece of text between white space, computed once for each."""

    #: Pieces kept; beyond that the table is begun anew at the next text.
    KEPT = 500_000

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.words: list[str] = []
        self._codes: list[int] = []
        self._flags: list[int] = []
        self._arrays: tuple[np.ndarray, np.ndarray] | None = None

    def _new(self, piece: str) -> int:
        word = _DROP.sub("", piece).lower()
        flags = 0 if word else _EMPTY
        if word:
            first = next(c for c in piece if c.isalnum())
            if _NUMBER.fullmatch(word):
                flags |= _IS_NUMBER
            elif _DICE.match(word):
                flags |= _IS_DICE
            elif first.isupper() and not (len(word) > 1 and piece.isupper()) and word not in FUNCTION_WORDS:
                flags |= _NAME_LIKE
            elif word in UNITS or SYMBOLS.fullmatch(word) or (word.isalpha() and len(word) > 3 and word.endswith("s")):
                flags |= _UNIT_LIKE
        found = self.ids[piece] = len(self.words)
        self.words.append(word)
        self._codes.append(xxhash.xxh64_intdigest(word))
        self._flags.append(flags)
        self._arrays = None
        return found

    def read(self, text: str) -> np.ndarray:
        """Ids of the words of a text."""
        broken = _LINE_END.search(text) is not None
        if broken and "­" in text:  # a soft hyphen at a line end breaks a word, elsewhere it isn't drawn
            text = _BROKEN.sub("", text)
        text = canonical(text)
        pieces = (_BROKEN.sub("", text) if broken else text).split()
        known = self.ids
        try:
            ids = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        except KeyError:
            ids = np.fromiter((known[p] if p in known else self._new(p) for p in pieces), np.int64, len(pieces))
        return ids[(self.arrays()[1][ids] & _EMPTY) == 0] if len(ids) else ids

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self._arrays is None:
            self._arrays = np.array(self._codes, np.uint64), np.array(self._flags, np.uint8)
        return self._arrays


class Template:
    """One or more texts in a row: their words, and both templates as codes with the word each code begins at.

    ``starts`` has the first word of every text and the end of the last.
    """

    __slots__ = ("_said", "at", "codes", "ids", "literal", "raw", "starts", "words")

    def __init__(self, words: Words, texts: list[np.ndarray]) -> None:
        ids = np.concatenate([np.zeros(0, np.int64), *texts])
        self.words, self.ids = words, ids
        self._said: list[list[str] | None] = [None, None]
        self.starts = np.cumsum([0, *map(len, texts)])
        codes, flags = words.arrays()
        self.raw = codes[ids] if len(ids) else np.zeros(0, np.uint64)
        kind = flags[ids] if len(ids) else np.zeros(0, np.uint8)
        number, dice, name = (kind & _IS_NUMBER) > 0, (kind & _IS_DICE) > 0, (kind & _NAME_LIKE) > 0
        after = np.concatenate([[False], number])
        after[self.starts] = False  # a text goes on from no other
        after = after[:-1]
        unit = ((kind & _UNIT_LIKE) > 0) & after
        first = self.raw.copy()
        for what, code in ((number, "number"), (dice, "dice"), (unit, "unit")):
            first[what] = _CODES[code]
        second = np.where(name, _CODES["name"], first)
        kept = ~(number & after)  # a number of several words is one
        placed = number | dice | unit
        self.codes = first, second[kept]
        self.literal = ~placed, ~(placed | name)[kept]
        self.at = np.arange(len(ids) + 1), np.concatenate([np.flatnonzero(kept), [len(ids)]])

    def said(self, form: int) -> list[str]:
        """What stands under every code, words of one code joined by a space."""
        if self._said[form] is None:
            known = self.words.words
            words = [known[i] for i in self.ids.tolist()]
            at = self.at[form].tolist()
            self._said[form] = words if len(at) == len(words) + 1 else [words[x] if y - x == 1 else " ".join(words[x:y]) for x, y in zip(at, at[1:], strict=False)]
        return self._said[form]


def words_of(text: str) -> list[str]:
    """Words in the one form both sides are compared in."""
    words = Words()
    return [words.words[i] for i in words.read(text).tolist()]


def rolled(codes: np.ndarray, window: int) -> np.ndarray:
    """Hash of every window of codes."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    power = 1
    for k in range(window):
        out += codes[k : k + n] * np.uint64(power)
        power = power * _BASE & 0xFFFFFFFFFFFFFFFF
    return out


def windows(template: Template, form: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the windows of one form that lie within a text and tell something."""
    codes = template.codes[form]
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = rolled(codes, window)
    total = np.concatenate([[0], np.cumsum(template.literal[form])])
    telling = total[window:] - total[:-window] >= MIN_LITERAL
    # no window reaches over the end of its text
    ends = np.searchsorted(template.at[form], template.starts[1:])
    inside = np.ones(n, bool)
    for k in range(1, window):
        cut = ends - k
        inside[cut[(cut >= 0) & (cut < n)]] = False
    if form:
        inside &= telling
    elif not telling.all():
        h[~telling] = rolled(template.raw, window)[~telling] ^ _AS_WRITTEN
    place = np.flatnonzero(inside)
    return h[place], place


class Index:
    """Template windows of one block of evaluation items, sorted by hash, for each form."""

    def __init__(self, items: list[tuple], window: int) -> None:
        self.window = window
        self.ids = [i for i, _ in items]
        words = Words()
        self.items = [Template(words, [words.read(t)]) for _, t in items]
        self.forms = []
        for form in (0, 1):
            found = [windows(t, form, window) for t in self.items]
            # of equal windows of an item the first stands for all
            found = [(h[np.sort(f)], p[np.sort(f)]) for h, p in found for f in [np.unique(h, return_index=True)[1]]]
            h = np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in found)])
            item = np.repeat(np.arange(len(found)), [len(p) for _, p in found]) if found else np.zeros(0, np.int64)
            place = np.concatenate([np.zeros(0, np.int64), *(p for _, p in found)])
            order = np.argsort(h, kind="stable")
            self.forms.append((h[order], item[order].astype(np.int64), place[order]))

    def hits(self, form: int, hashes: np.ndarray) -> np.ndarray:
        """Which of many hashes are in the index."""
        known = self.forms[form][0]
        if not len(known) or not len(hashes):
            return np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.flatnonzero(known[i] == hashes)

    def runs(self, doc: Template, found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
        """Runs of a document with hits (hash, place) in each form."""
        out: list[tuple] = []
        whole: list[tuple] = []  # of the first form, as (item, start, end)
        for form, (hashes, places) in enumerate(found):
            for item, start, end, shift in self._stretches(form, doc, hashes, places):
                row = self._run(form, doc, item, start, end, shift)
                a, b = row[1], row[1] + row[3]
                if not form:
                    whole.append((item, a, b))
                elif not row[6] or any(i == item and x <= a and b <= y for i, x, y in whole):
                    continue  # nothing changed, or no more than the first form found
                out.append(row)
        return out

    def _stretches(self, form: int, doc: Template, hashes: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, first code, end, shift) of the stretches on one diagonal that agree and hold a hit."""
        known, items, positions = self.forms[form]
        low, high = np.searchsorted(known, hashes, "left"), np.searchsorted(known, hashes, "right")
        diagonals: dict[tuple[int, int], list[int]] = {}
        for p, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
            for j in range(a, b):
                diagonals.setdefault((int(items[j]), p - int(positions[j])), []).append(p)
        mine = doc.codes[form]
        for (item, shift), at in sorted(diagonals.items()):
            theirs = self.items[item].codes[form]
            first, last = max(0, shift), min(len(mine), len(theirs) + shift)
            differs = mine[first:last] != theirs[first - shift : last - shift]
            ends = np.flatnonzero(np.concatenate([[True], differs, [True]])) + first - 1
            done = -1
            for p in sorted(at):
                if p >= done:
                    k = int(np.searchsorted(ends, p, "right"))
                    start, end = int(ends[k - 1]) + 1, int(ends[k])
                    if end - start < self.window:  # equal hashes of different windows
                        continue
                    done = end
                    yield item, start, end, shift

    def _run(self, form: int, doc: Template, item: int, start: int, end: int, shift: int) -> tuple:
        other = self.items[item]
        longest = now = slots = changed = 0
        there: dict[str, str] = {}
        back: dict[str, str] = {}
        consistent = True
        pairs = zip(doc.said(form)[start:end], other.said(form)[start - shift : end - shift], other.literal[form][start - shift : end - shift].tolist(), strict=True)
        for a, b, literal in pairs:
            if a == b:
                now += 1 + a.count(" ")
                longest = max(longest, now)
            else:
                now = 0
            if not literal:
                slots += 1
                changed += a != b
                consistent &= there.setdefault(b, a) == a and back.setdefault(a, b) == b
        mine, theirs = doc.at[form], other.at[form]
        return self.ids[item], int(mine[start]), int(theirs[start - shift]), int(mine[end] - mine[start]), longest, slots, changed, consistent


_BUILT: dict[str, Index] = {}


def _index(name: str, items: list[tuple], window: int) -> Index:
    """The index of a block, built once in each worker process."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Index(items, window)
    return _BUILT[name]


def find_runs(index: Index, words: Words, texts: list[str]) -> Iterator[tuple[int, tuple]]:
    """(place of the text, run) for many texts, looked up together."""
    if len(words.ids) > words.KEPT:
        words.clear()
    read = [words.read(t) for t in texts]
    every = Template(words, read)
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for form in (0, 1):
        h, p = windows(every, form, index.window)
        hit = index.hits(form, h)
        if not len(hit):
            continue
        h, p = h[hit], p[hit]
        begins = np.searchsorted(every.at[form], every.starts)
        of = np.searchsorted(begins, p, "right") - 1
        # a window equal to the one before it says nothing new
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (np.diff(p) > 1) | (of[1:] != of[:-1])])
        h, p, of = h[new], p[new], of[new]
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist()
        for x, y in zip(cuts, cuts[1:], strict=False):
            k = int(of[x])
            found.setdefault(k, [none, none])[form] = h[x:y], p[x:y] - begins[k]
    for k, hits in sorted(found.items()):
        for r in index.runs(Template(words, [read[k]]), hits):
            yield k, r


def runs(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 12, block_words: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, ...RUN_COLUMNS): runs of at least ``window`` template words shared by document and item."""
    doc_type, item_type = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t")).where("t is not null")
    kinds = [to_arrow_type(item_type), *[pa.int32()] * 6, pa.bool_()]
    names = ["doc_id", "item_id", *(c.split()[0] for c in RUN_COLUMNS.split(", "))]

    def one_pass(block: list[tuple]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, words = _index(name, shared.value, window), Words()
            for batch in batches:
                for piece in range(0, batch.num_rows, 512):
                    part = batch.slice(piece, 512)
                    rows, found = [], []
                    for k, r in find_runs(index, words, part.column(1).to_pylist()):
                        rows.append(k)
                        found.append(r)
                    columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

        return source.mapInArrow(run, f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, {RUN_COLUMNS}")

    blocks, block, size = [], [], 0
    chosen = items.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct().orderBy("i", "t")
    for row in chosen.toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t) // 4
        if size >= block_words:
            blocks.append(one_pass(block))
            block, size = [], 0
    if block or not blocks:
        blocks.append(one_pass(block))
    out = blocks[0]
    for more in blocks[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("doc_id", doc_id).withColumnRenamed("item_id", item_id)
