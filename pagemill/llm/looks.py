"""One form for text of the same look (problem 2).

A compiled longest-match transducer rewrites text over grapheme clusters in one pass: widths,
make-up of accented and joined letters, invisible characters, spaces and look-alike letters. Its
mapping is computed once, before any text is seen, from the Unicode data of this Python and the tables
below: a trie whose paths are single characters that change and all sequences of a base and its marks
that compose, with every base that looks like it. Undrawn characters are passed over wherever they
stand. The mapping is checked for conflicts before use: it must be closed and stable, case must stay, and
letters that are kept must not become one another.

What stays: case, accents, line breaks, the number of spaces, punctuation, quotes, dashes, tabs. A
letter that has a twin of another script in ``LOOKALIKES`` becomes the Latin twin, so that equality of looks
is equality of strings. In a word with letters that only one other script has, and none that only Latin
has, the twins are those of that script: such a word stays in its script, and so does its equality, since
the choice depends on letters without a twin alone.

Defined results: null gives null, empty gives empty; a text of only invisible characters gives the
empty string; the result is the same when applied again.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.session import materialize

# Letters of other scripts and the Latin letters they look like.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y", "ӏ": "l",
    "ɡ": "g",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮍ": "Y", "Ꮓ": "Z",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    "ᗅ": "A", "ᗷ": "B", "ᗞ": "D", "ᕼ": "H", "ᒍ": "J", "ᒪ": "L", "ᑭ": "P", "ᖇ": "R", "ᑌ": "U", "ᐯ": "V", "᙭": "X",
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲭ": "X", "ⲭ": "x",
    "Օ": "O", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g",
}
# Characters that are drawn as a space, and those that break a line.
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
BREAKS = "\r\u0085\u2028\u2029"
# Characters that are not drawn, besides control and format characters.
UNDRAWN = "\u034f\u115f\u1160\u17b4\u17b5\u2800\u3164\uffa0\u180b\u180c\u180d\ufe00\ufe01\ufe02\ufe03\ufe04\ufe05\ufe06\ufe07\ufe08\ufe09\ufe0a\ufe0b\ufe0c\ufe0d\ufe0e\ufe0f"
#: Compatibility classes whose characters look like what they stand for.
_SAME_LOOK = {"<wide>", "<narrow>"}


def _invisible(ch: str) -> bool:
    kind = unicodedata.category(ch)
    return ch in UNDRAWN or kind == "Cf" or (kind == "Cc" and ch not in "\t\n\r\u0085") or 0xE0100 <= ord(ch) <= 0xE01EF


def _joined(ch: str) -> str | None:
    """What a joined letter is made of: typographic ligatures and letter pairs."""
    if 0xFB00 <= ord(ch) <= 0xFB06 or 0x0132 <= ord(ch) <= 0x0133 or 0x01C7 <= ord(ch) <= 0x01CC or 0x01F1 <= ord(ch) <= 0x01F3:
        return unicodedata.normalize("NFKC", ch)
    return None


def _unit(ch: str) -> str:
    """Form of one code point that stands alone, accents taken apart."""
    if ch in SPACES:
        return " "
    if ch in BREAKS:
        return "\n"
    if _invisible(ch):
        return ""
    if (parts := _joined(ch)) is not None:
        return unicodedata.normalize("NFD", parts)
    way = unicodedata.decomposition(ch).split(" ")[0]
    if way in _SAME_LOOK:
        return "".join(_unit(c) for c in unicodedata.normalize("NFKC", ch))
    return "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFD", ch))


#: Code points whose characters may change.
_RANGES = ((0x0, 0x3400), (0xA4D0, 0xAC00), (0xF900, 0x20000), (0x2F800, 0x2FA20), (0xE0000, 0xE0200))
#: Letters of one script that are drawn alike, so that both may become one Latin letter.
_DRAWN_ALIKE = ({"У", "Ү"}, {"у", "ү"}, {"І", "Ӏ"})


def _script(ch: str) -> str:
    """Script of a letter, by the first word of its name."""
    return unicodedata.name(ch, "?").split(" ")[0]


class Transducer:
    """Longest-match rewriting by a compiled trie, run over stretches of odd characters.

    Printable ASCII, tabs and line feeds stand for themselves, so only the stretches of other
    characters, with the base before them where marks attach to it, can change.
    """

    #: Stretches kept per process; beyond that they are rewritten again.
    KEPT = 100_000

    def __init__(self) -> None:
        self.table: dict[str, str] = {}
        self.undrawn: set[str] = set()
        letters: dict[str, list[str]] = {}  # characters by the single one they look like
        for c in (c for low, high in _RANGES for c in range(low, high) if not 0xD800 <= c < 0xF900):
            ch = chr(c)
            form = unicodedata.normalize("NFC", _unit(ch))
            if not form:
                self.undrawn.add(ch)
            elif form != ch:
                self.table[ch] = form
                if len(form) == 1:
                    letters.setdefault(form, []).append(ch)
        for c in range(0xC0, 0x3400):
            whole = chr(c)
            parts = unicodedata.normalize("NFD", whole)
            if len(parts) > 1 and unicodedata.is_normalized("NFC", whole) and parts[0] not in LOOKALIKES:
                # a base, or a base with its first marks composed, and what follows
                for k in range(1, len(parts)):
                    base = unicodedata.normalize("NFC", parts[:k])
                    if len(base) == 1:
                        for b in [base, *letters.get(base, ())]:
                            self.table[b + parts[k:]] = whole
        self.check()
        self.trie: dict = {}
        for source, form in self.table.items():
            node = self.trie
            for ch in source:
                node = node.setdefault(ch, {})
            node[""] = form
        self.native = _native_twins()
        self.odd = re.compile(r"[^\t\n\x20-\x7e]+")
        self.foreign = re.compile("[" + "".join(sorted({c for own, _ in self.native.values() for c in own})) + "]")
        self.stretches: dict[str, str] = {}

    def check(self) -> None:
        """Raise unless the mapping is closed, stable and keeps different looks apart."""
        for source, form in self.table.items():
            again = unicodedata.normalize("NFC", "".join(_unit(c) for c in form))
            if again != form or any(self.table.get(c, c) != c or c in self.undrawn for c in form):
                raise ValueError(f"mapping of {source!r} isn't stable: {form!r}, {again!r}")
        kept = [chr(c) for c in range(0x20, 0x7F)] + [chr(c) for c in range(0xA1, 0x180) if c != 0xAD and unicodedata.category(chr(c)) != "Cf" and _joined(chr(c)) is None and chr(c) not in LOOKALIKES]
        kept += ["\t", "\n", *"‘’“”‚„‹›«»‐‑–—―…•"]
        for ch in kept:
            if self.table.get(ch, ch) != ch or ch in self.undrawn:
                raise ValueError(f"{ch!r} must stay")
        twins: dict[tuple[str, str], str] = {}
        for source, form in LOOKALIKES.items():
            if form in LOOKALIKES or (source.lower() != source.upper() and source.isupper() != form.isupper()):
                raise ValueError(f"{source!r} and {form!r} differ in case or chain")
            other = twins.setdefault((_script(source), form), source)
            if other != source and {other, source} not in _DRAWN_ALIKE:
                raise ValueError(f"{source!r} and {other!r} of one script look different and share {form!r}")

    def _rewrite(self, text: str) -> str:
        """Form of a stretch: at each place the longest path of the trie, past undrawn characters."""
        out: list[str] = []
        i, n = 0, len(text)
        while i < n:
            node, j, best = self.trie, i, None
            while j < n:
                ch = text[j]
                if ch not in self.undrawn:
                    node = node.get(ch)
                    if node is None:
                        break
                    if "" in node:
                        best = node[""], j + 1
                j += 1
            if best:
                out.append(best[0])
                i = best[1]
            else:
                if text[i] not in self.undrawn:
                    out.append(text[i])
                i += 1
        form = "".join(out)
        # marks in another order than that of their classes, or more of them than any letter is made of
        return form if unicodedata.is_normalized("NFC", form) else unicodedata.normalize("NFC", form)

    def __call__(self, text: str) -> str:
        out, done = [], 0
        for m in self.odd.finditer(text):
            a, b = m.span()
            stretch = m.group()
            if stretch[-1] == "\r" and text.startswith("\n", b):
                stretch = stretch[:-1]
            if a > done and stretch and _attaches(stretch[0]) and text[a - 1] not in "\t\n":
                a -= 1
                stretch = text[a] + stretch
            form = self.stretches.get(stretch)
            if form is None:
                form = self._rewrite(stretch)
                if len(self.stretches) < self.KEPT:
                    self.stretches[stretch] = form
            out.append(text[done:a])
            out.append(form)
            done = b
        if not out:
            return text
        out.append(text[done:])
        form = "".join(out)
        return _WORD.sub(self._in_script, form) if self.foreign.search(form) else form

    def _in_script(self, m: re.Match) -> str:
        """A word of one form, with the twins of the one other script that its letters without a twin are of."""
        word = unicodedata.normalize("NFD", m.group())
        scripts = {_script(c) for c in word if c.isalpha() and not ("A" <= c <= "Z" or "a" <= c <= "z")}
        if len(scripts) != 1 or (script := scripts.pop()) not in self.native:
            return m.group()
        own, twins = self.native[script]
        if any(c.isalpha() and c not in own and c not in twins for c in word):
            return m.group()
        return unicodedata.normalize("NFC", "".join(twins.get(c, c) for c in word))


_WORD = re.compile(r"(?:[^\W\d_][\u0300-\u036f]*)+")


def _native_twins() -> dict[str, tuple[set[str], dict[str, str]]]:
    """For each script with twins: its letters without a twin, and its own letter for each Latin one."""
    twins: dict[str, dict[str, str]] = {}
    for source, form in LOOKALIKES.items():
        if _script(source) != "LATIN":
            twins.setdefault(_script(source), {}).setdefault(form, source)
    own: dict[str, set[str]] = {script: set() for script in twins}
    for ch in map(chr, [*range(0x370, 0x590), *range(0x13A0, 0x1400), *range(0x1400, 0x1680), *range(0x2C80, 0x2D00), *range(0xA4D0, 0xA500)]):
        if ch.isalpha() and ch not in LOOKALIKES and (script := _script(ch)) in own and unicodedata.normalize("NFD", ch)[0] not in LOOKALIKES:
            own[script].add(ch)
    return {script: (own[script], twins[script]) for script in twins if own[script]}


@lru_cache(maxsize=65_536)
def _attaches(ch: str) -> bool:
    """Whether a character belongs to the cluster before it."""
    return unicodedata.category(ch)[0] == "M" or ch in "ﾞﾟ" or (ch > "\x7e" and ch not in SPACES and _invisible(ch)) or (ch < " " and _invisible(ch))


_ONE: list[Transducer] = []


def transducer() -> Transducer:
    """The transducer of this process, compiled once."""
    if not _ONE:
        _ONE.append(Transducer())
    return _ONE[0]


def canonical(text: str | None) -> str | None:
    return None if text is None else transducer()(text)


@F.pandas_udf(T.StringType())
def _canonical_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    one = transducer()
    for texts in parts:
        yield pd.Series([None if t is None else one(t) for t in texts], dtype=object)


# never evaluated a second time below a filter on its result
_canonical_udf = _canonical_udf.asNondeterministic()


def same_look(text: Column) -> Column:
    """The one form of a text column. Plain text stays in the JVM; only other text goes to Python."""
    return F.coalesce(_canonical_udf(F.when(text.rlike(r"[^\t\n\x20-\x7e]"), text)), text)


def _writings(df: DataFrame, group: str, key: str, fields: tuple[str, ...]) -> DataFrame:
    """(g, field, f, r, k): hashes of form and writing of every value whose form has another writing than itself.

    The transducer runs once over all values; what it found is written as keys and 128-bit hashes.
    """
    one = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields]
    rows = df.select(F.col(group).alias("g"), F.col(key).alias("k"), F.explode(F.array(*one)).alias("v")).select("g", "k", "v.field", "v.raw")
    rows = rows.where("g is not null and k is not null and raw is not null").withColumn("form", same_look(F.col("raw"))).where(r"form rlike '\\S'")
    hashed = materialize(rows.select("g", "k", "field", F.unhex(F.md5(F.col("form").cast("binary"))).alias("f"), F.unhex(F.md5(F.col("raw").cast("binary"))).alias("r")), "look-hashes")
    odd = hashed.where("f <> r").select("g", "field", "f").distinct()
    return hashed.join(odd, ["g", "field", "f"], "left_semi").distinct()


def look_classes(df: DataFrame, group: str = "book_id", key: str = "block_id", fields: tuple[str, ...] = ("text", "title")) -> DataFrame:
    """Classes of equal look: (group, key, field, class_id, writing_id, n_members, n_links), a row for each member and writing.

    Only classes with more than one writing are given. ``class_id`` and ``writing_id`` are hashes of the
    form and of the value as written; a member is linked to the members of its class that are written
    otherwise. All links of a class follow from these rows, which grow with the members, not with pairs.
    """
    members = _writings(df, group, key, fields)
    # counted by writing first, so that many copies of one value are merged before they move
    written = members.groupBy("g", "field", "f", "r").agg(F.count("*").alias("n"))
    classes = written.groupBy("g", "field", "f").agg(F.sum("n").alias("n_members"), F.count("*").alias("n_writings")).where("n_writings > 1")
    counts = written.join(classes, ["g", "field", "f"])
    rows = members.join(counts, ["g", "field", "f", "r"])
    text = lambda c: F.lower(F.hex(c))
    return rows.select(F.col("g").alias(group), F.col("k").alias(key), "field", text("f").alias("class_id"), text("r").alias("writing_id"), "n_members", (F.col("n_members") - F.col("n")).alias("n_links"))


def look_pairs(df: DataFrame, group: str = "book_id", key: str = "block_id", fields: tuple[str, ...] = ("text", "title"), salts: int = 8) -> DataFrame:
    """Pairs of rows of one group whose values of a field look the same but are written differently.

    Returns distinct (group, key_a, key_b, field), key_a the smaller string. Null and blank values are
    left out, and so are rows with a null key or group; rows that arrive again count once.

    Only values that are not in their one form can open a pair, so the search starts from their
    hashes; everything shuffled is keys and 128-bit hashes, never text. Pairs are joined from pairs
    of writings, so rows written alike never meet, and the members of one writing are spread over
    ``salts`` tasks.
    """
    members = materialize(_writings(df, group, key, fields), "look-members")
    writing = members.select("g", "field", "f", "r").distinct()
    both = writing.select("g", "field", "f", F.col("r").alias("ra")).join(writing.select("g", "field", "f", F.col("r").alias("rb")), ["g", "field", "f"]).where("ra < rb").drop("f")
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    a = members.select("g", "field", F.col("r").alias("ra"), F.col("k").alias("ka"), F.pmod(F.xxhash64("k"), F.lit(salts)).cast("int").alias("s"))
    b = members.select("g", "field", F.col("r").alias("rb"), F.col("k").alias("kb"))
    out = both.withColumn("s", salt).join(a, ["g", "field", "ra", "s"]).join(b, ["g", "field", "rb"]).where("ka <> kb")
    return out.select(F.col("g").alias(group), F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"), "field").distinct()
