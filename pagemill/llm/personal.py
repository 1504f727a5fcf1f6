"""Personal information inside free text (problem 8).

Offset-preserving deobfuscation: a chain of small transducers rewrites a text into a plain one
(letters of equal look, spaces and dashes of one kind, undrawn characters gone, spelled digits as
digits, at and dot disguises as ``@`` and ``.``) while it keeps for every character where it came from.
Detectors run on the plain text, and their spans are mapped back to the source, where they are
replaced by a placeholder of their type. The rest of the text isn't touched.

Kinds: ``email``, ``phone``, ``id`` (numbers that identify a person), ``address`` (street and number
or post-office box, with the town) and ``name`` (given and family name in either order). Of
overlapping spans the earlier kind in this order wins, except that identity numbers go before phones.

The list of names is incomplete, so family names are also known by their parts: an ending that at
least ``min_family`` listed family names share, after a beginning of three letters or more.

After a bare ``at`` the word ``point`` is a dot only before two letters that are no English word or a
common end of domains, since "at this point" is plain English too.

Defined results: null texts give null and no mentions, empty ones themselves; each row is treated by
itself, so rows that come again give equal results; the whole of a text is read whatever its length;
other columns are carried, one with the name of an added column as ``<name>_input``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.looks import canonical
from pagemill.llm.naming import make_room

KINDS = ("email", "address", "id", "phone", "name")
MENTIONS = "array<struct<kind:string,start:int,end:int,line_no:int>>"
RESULT = f"struct<mentions:{MENTIONS},redacted:string>"

# Digits as words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_DASHES = dict.fromkeys("‐‑‒–−﹣", "-")
# a letter with the marks and undrawn characters after it goes as one, so that it is composed
_ODD = re.compile(r"\w[\u0300-\u036f\u200b-\u200d\u00ad\u2060\ufeff]+|[^\t\n\x20-\x7e]")


class Plain:
    """A text with, for every character, the bounds of its source."""

    __slots__ = ("ends", "starts", "text")

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        self.text, self.starts, self.ends = text, starts, ends

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (self.starts[a], self.ends[b - 1])

    def rewrite(self, pattern: re.Pattern, form) -> Plain:
        """Every match replaced by ``form(match)``; None leaves it."""
        pieces, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = form(m)
            if new is None or new == m.group():
                continue
            a, b = m.span()
            pieces += [self.text[done:a], new]
            self._keep(starts, ends, done, a)
            s, e = self.source(a, b)
            starts += [s] * len(new)
            ends += [e] * len(new)
            done = b
        if not done:
            return self
        pieces.append(self.text[done:])
        self._keep(starts, ends, done, len(self.text))
        return Plain("".join(pieces), starts, ends)

    def _keep(self, starts: list[int], ends: list[int], a: int, b: int) -> None:
        starts += range(a, b) if self.starts is None else self.starts[a:b]
        ends += range(a + 1, b + 1) if self.ends is None else self.ends[a:b]


_LOOKS: dict[str, str] = {}


def _look(m: re.Match) -> str:
    ch = m.group()
    form = _LOOKS.get(ch)
    if form is None:
        form = _LOOKS[ch] = _DASHES.get(ch) or canonical(ch)
    return form


# characters met so far that stay as they are, and others; marks and undrawn ones count with the others
_SAME: set[str] = {chr(c) for c in range(0x20, 0x7F)} | {"\t", "\n"}
_OTHER: set[str] = set()


def _changes(text: str) -> bool:
    """Whether any character of a text may become another."""
    chars = set(text)
    for ch in chars - _SAME - _OTHER:
        stays = unicodedata.category(ch)[0] not in "MC" and ch not in _DASHES and canonical(ch) == ch
        (_SAME if stays else _OTHER).add(ch)
    return not chars.isdisjoint(_OTHER)


_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_THREE = b"\x01" * 3
_SPELLED = re.compile(rf"\b(?:{_WORD})(?:[\s,-]+(?:{_WORD})){{4,}}\b", re.I)
_ONE_WORD = re.compile(_WORD, re.I)
_OPEN, _SHUT = r"[(\[{<]", r"[)\]}>]"
# local part, a disguised or spaced at, and a domain whose dots may be disguised too; a bare word "at"
# counts only where the domain's dots are words, and as "at this point in" is plain English, only before
# what can't be it: a "point" needs an end of domains after it, and articles and the like are no host
_AT = rf"(?:\s*{_OPEN}\s*(?:at|a|@|ät|arroba|chez)\s*{_SHUT}\s*|\s*@\s*)"
_SAID = r"\s+(?:dot|punkt|point|punto)\s+"
_DOT = rf"(?:\s*{_OPEN}\s*(?:dot|\.|punkt|point|punto)\s*{_SHUT}\s*|{_SAID}|\.(?=\w))"
_LOCAL = r"[A-Za-z0-9](?:[A-Za-z0-9_%+'-]|\.(?=[A-Za-z0-9_]))*"
# a name set letter by letter is taken whole
_SPACED = r"(?:[A-Za-z0-9][^\S\n]){2,}[A-Za-z0-9]"
_WHO = rf"(?<![\w.+@-])({_SPACED}|{_LOCAL}(?:{_SAID}{_LOCAL}){{0,3}}?)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9]|-(?:\n[^\S\n]*)?(?=[A-Za-z0-9]))*"
_BARE = r"\s+(?:at|arroba)\s+"
_SURE = r"\s+(?:dot|punkt|punto)\s+"
_ENDS = r"(?:com|net|org|edu|gov|mil|biz|info|example|invalid|localhost)\b"
_TOP = rf"(?:{_ENDS}|(?!am|an|as|at|be|by|do|go|he|if|in|is|it|me|my|no|of|on|or|so|to|up|us|we)[a-z]{{2}}\b)"
_ARTICLE = r"(?:a|an|any|each|every|her|his|its|my|no|one|our|some|that|the|their|these|this|those|what|which|your)"
_HOST = rf"(?!{_ARTICLE}\s+point\s|{_ARTICLE}{_SURE}(?!{_ENDS}))"
_DISGUISED = [
    re.compile(rf"{_WHO}({_AT})({_LABEL}(?:{_DOT}{_LABEL}){{1,4}})(?![\w@])", re.I),
    re.compile(rf"{_WHO}(\s+at\s+)({_HOST}(?:{_LABEL}(?:{_SAID}{_LABEL}){{0,3}}{_SAID}{_TOP}(?!{_SURE}{_LABEL})|{_LABEL}(?:{_SURE}{_LABEL}){{1,4}}))(?![\w@])", re.I),
    re.compile(rf"{_WHO}(\s+arroba\s+)({_LABEL}(?:{_SAID}{_LABEL}){{1,4}})(?![\w@])", re.I),
]
# what a text must hold for the first of them, and for the others
_ANY_AT, _ANY_BARE, _ANY_SAID = (re.compile(p, re.I) for p in (rf"@|{_OPEN}\s*(?:at|a|ät|arroba|chez)\s*{_SHUT}", _BARE, _SAID))
_DOT_ONLY = re.compile(_DOT, re.I)


def _undisguise(m: re.Match) -> str:
    local, _, domain = m.groups()
    return re.sub(r"\s+", "", _DOT_ONLY.sub(".", local)) + "@" + re.sub(r"\s+", "", _DOT_ONLY.sub(".", domain))


def plain(text: str) -> Plain:
    """The source through all transducers."""
    out = Plain(text)
    if _changes(text):
        out = out.rewrite(_ODD, _look)
    # of five words for digits in a row the inner three have nothing but separators around them: few texts have such
    words = out.text.lower().replace(",", " ").replace("-", " ").split()
    if _THREE in bytes(map(DIGIT_WORDS.__contains__, words)):
        out = out.rewrite(_SPELLED, lambda m: "".join(DIGIT_WORDS[w.lower()] for w in _ONE_WORD.findall(m.group())))
    if _ANY_AT.search(out.text):
        out = out.rewrite(_DISGUISED[0], _undisguise)
    if (at := _ANY_BARE.search(out.text)) and _ANY_SAID.search(out.text, at.end()):
        for pattern in _DISGUISED[1:]:
            out = out.rewrite(pattern, _undisguise)
    return out


_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.%+'-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")

# What streets are called, and words for the parts of a house.
_STREETS = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Close|Drive|Dr|Court|Ct|Crescent|Cres|Rise|Way|Place|Pl|Square|Sq|Terrace|Row|Walk|Hill|Quay|Gardens|Grove|Boulevard|Blvd|Alley|Parade|Mews|Yard|Wharf|View|Parkway)\b\.?"
_PART = r"(?:Flat|Apt|Apartment|Unit|Suite|Room|Floor)\.?\s*\d+[A-Za-z]?"
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’]*[\w](?:-[A-Z]\w+)?"
# a town's name runs over a line end only after or before a word that is part of such names
_BEFORE = r"(?:Bad|East|West|North|South|New|Old|Port|Lower|Upper|Saint|Great|Little|Sankt|San|Santa|Le|La)"
_AFTER = r"(?:Cross|Bay|Hill|Green|Heath|Bridge|Ford|City|Park|Falls|Springs|Beach|Harbou?r|Island|Point|Grove|Vale|Common|Wells|Junction)\b"
_TOWN = rf"(?:{_BEFORE}\s+(?:{_CAP}[^\S\n]+)?{_CAP}|{_CAP}(?:(?:[^\S\n]+|\n(?={_AFTER})){_CAP}){{0,2}})(?:\n{_AFTER})?"
_EN = rf"(?:{_CAP}[^\S\n]+)?{_CAP}\s+{_STREETS}"
_NO = r"\d{1,4}\s?[A-Za-z]?(?![\w-])"
_ZIP = r"\d{4,6}(?!\d)"
_DE = r"(?:[A-ZÄÖÜ][\wäöüß]*(?:straße|strasse|str\.|allee|gasse|ring|weg|platz|ufer|damm|markt|steig|hof)|(?:Am|An der|Im|In der|Zum|Zur|Auf dem|Unter den)\s+[A-ZÄÖÜ]\w+(?:\s+[A-ZÄÖÜ]\w+)?|[A-ZÄÖÜ]\w+er\s+(?:Straße|Weg|Allee|Platz))"
_ROMANCE = r"(?:(?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Pp]lace|[Cc]hemin|[Qq]uai|[Ii]mpasse|[Aa]llée|[Cc]alle|[Aa]venida|[Pp]laza|[Pp]aseo|[Cc]amino)\s+(?:(?:de|del|la|le|les|des|du|los|las|el|l['’]|d['’])\s*)*" + _CAP + r"(?:\s+(?:de|du|la|des|del)?\s*" + _CAP + r")?)"
_ADDRESS_FORMS = (
    rf"(?:{_PART},?\s+)?(?<![\w-]){_NO},?\s+{_EN},?\s+(?:{_PART},?\s+)?{_TOWN},?\s+{_ZIP}",
    rf"(?:{_PART},?\s+)?(?<![\w-]){_NO},?\s+{_EN},\s+(?:{_PART},\s+)?{_TOWN}",
    rf"(?:{_PART},?\s+)?\b{_EN}\s+{_NO},\s+(?:{_PART},?\s+)?{_TOWN}(?:,?\s+{_ZIP})?",
    rf"\b{_DE}\s+{_NO},?\s+(?:D-)?{_ZIP}\s+{_TOWN}",
    rf"(?:(?<![\w-]){_NO},?\s+{_ROMANCE}|\b{_ROMANCE},?\s+{_NO}),?\s+(?:{_ZIP}\s+{_TOWN}|{_TOWN},?\s+{_ZIP})",
    rf"\b(?:P\.?\s?O\.?\s+Box|Postfach|Boîte\s+postale|B\.?P\.?|Apartado(?:\s+de\s+[Cc]orreos)?)\s+\d[\d ]*,?\s+(?:{_ZIP}\s+{_TOWN}|{_TOWN}(?:,?\s+{_ZIP})?)",
)
_ADDRESSES = [re.compile(p) for p in _ADDRESS_FORMS]
# what a text must hold for each of the forms: each hint is a part of its form
_STREET_HINT = re.compile(rf"\s(?=[A-Z]){_STREETS}")
_HINTS = [
    _STREET_HINT, _STREET_HINT, _STREET_HINT, re.compile(rf"\d\s?[A-Za-z]?,?\s+(?:D-)?{_ZIP}\s+[A-ZÀ-ÖØ-Þ]"),
    re.compile(r"(?<![^\W_])(?=[RrAaBbPpCcQqIi])(?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Pp]lace|[Cc]hemin|[Qq]uai|[Ii]mpasse|[Aa]llée|[Cc]alle|[Aa]venida|[Pp]laza|[Pp]aseo|[Cc]amino)\s"),
    re.compile(r"Box|Postfach|postale|B\.?P|Apartado"),
]
# In capitals every word looks like a name: there the words of the patterns count in either case, and
# words that are part of no street or town are no names. Such stretches end at a word in small letters,
# except those that the patterns themselves know.
_NO_NAME = r"(?!(?:A|AN|AND|ARE|AS|AT|BEFORE|BY|FOR|FROM|HAS|IF|IN|IS|OF|ON|OR|THE|THEN|TO|UNTIL|WAS|WHEN|WHERE|WITH|BEI|BIS|MIT|NACH|ODER|UND|VON|CHEZ|ET|OU|POUR|CON|PARA|Y)\b)"
_IN_CAPITALS = [re.compile(p.replace(_CAP, _NO_NAME + _CAP), re.I) for p in _ADDRESS_FORMS]
_SMALL = re.compile(r"(?<![\w'’-])(?!(?:de|del|la|le|les|des|du|los|las|el|d|l|der|den|dem|rue|avenue|boulevard|place|chemin|quai|impasse|allée|calle|avenida|plaza|paseo|camino|postale|correos)\b)[a-zß-öø-ÿ]{2}[\w'’-]*")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]{2}")
_HOUSE = re.compile(r"\d")

_ID_WORD = (
    r"(?:ssn|social\s+security(?:\s+(?:number|no\.?))?|(?:national\s+)?insurance\s+(?:number|no\.?|id)|nino|passport(?:\s+(?:number|no\.?|id))?|national\s+id(?:entity)?(?:\s+(?:number|no\.?|card))?"
    r"|identity\s+(?:card\s+)?(?:number|no\.?)|id\s+(?:card|number|no\.?)|tax(?:payer)?\s+(?:id|number|no\.?|reference|code)|tin|(?:driver['’]?s?|driving)\s+licen[cs]e(?:\s+(?:number|no\.?))?|licen[cs]e\s+(?:number|no\.?)"
    r"|steuer-?(?:id(?:entifikationsnummer)?|nummer|nr\.?)|(?:personal)?ausweis-?(?:nummer|nr\.?)?|(?:reise)?pass-?(?:nummer|nr\.?)|führerschein-?(?:nummer|nr\.?)?|\w*versicherungs-?(?:nummer|nr\.?)|\w*versicherten-?nummer"
    r"|(?:numéro\s+(?:de\s+|d['’])(?:sécurité\s+sociale|passeport|identité|permis))|n°\s+(?:de\s+)?sécurité\s+sociale|passeport(?:\s+n[°o])?|permis\s+de\s+conduire|dni|nie|nif|número\s+de\s+(?:pasaporte|identidad|la\s+seguridad\s+social|seguridad\s+social)|pasaporte|licencia\s+de\s+conducir|carné\s+de\s+conducir)"
)
_ID_VALUE = r"(?=(?:[A-Z]*[ ./\n-]?){0,3}\d)[A-Z0-9]+(?![a-z])(?:[ ./-]\n?(?:[A-Z]{0,4}\d[A-Z0-9]*|[A-Z]{1,2})(?![A-Za-z])|\n[A-Z0-9]*\d[A-Z0-9]*(?![a-z])(?:[ ./-][A-Z0-9]+(?![A-Za-z]))*)*"
_IDS = [
    re.compile(rf"\b(?i:{_ID_WORD})\s*(?:(?i:is|was|ist|lautet|number|no\.?|nr\.?|nummer)\s+)?[:#=]?\s*({_ID_VALUE})"),
    re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])"),
    re.compile(r"(?<![\w-])([A-CEGHJ-PR-TW-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D])(?!\w)"),
]
_CALL = re.compile(r"(?:call(?:s|ed|ing)?|ring(?:s|ing)?|rang|phon(?:e|es|ed|ing)|tel|telephon(?:e|es|ed|ing)|telefon\w*|fon|fax(?:ed)?|mobile|mobil|cell|reach(?:es|ed|able)?|text(?:s|ed|ing)?|dial(?:s|l?ed|l?ing)?|unter|anruf\w*|rufen|téléphon\w*|tél|appel\w*|teléfono|móvil|llam\w*|number|at|or|oder|ou|o)[\s.:,#]*(?:me\s+at\s+|us\s+at\s+|is\s+|unter\s+)?$", re.I)
_EXT = r"(?:[,;]?\s*(?:ext|x|extension|durchwahl|app|poste|extensión)\.?\s*\d{1,5}(?!\d))?"
_S = r"[ ./\n-]"
_PHONES = [(re.compile(p + _EXT, re.I), need) for p, need in (
    (rf"(?<![\w+])\+\d{{1,3}}(?:{_S}{{0,2}}\(?\d{{1,5}}\)?){{2,7}}(?!\d)", False),
    (rf"(?<![\w.-])00\d{{1,3}}{_S}\(?\d{{1,5}}\)?(?:{_S}\d{{2,9}}){{1,5}}(?!\d)", False),
    (rf"(?<![\w./-])(?:1[ .-])?\(?\d{{3}}\)?{_S}\d{{3}}{_S}\d{{4}}(?![\d-])", False),
    (rf"(?<![\w./-])\(0\d{{1,4}}\){_S}?\d{{2,9}}(?:{_S}\d{{2,6}}){{0,3}}(?!\d)", False),
    (rf"(?<![\w./-])0\d{{1,4}}{_S}\d{{3,9}}(?:{_S}\d{{2,6}}){{0,3}}(?!\d)", False),
    (rf"(?<![\w./-])0\d(?:{_S}\d{{2}}){{4}}(?!\d)", False),
    (r"(?<![\w./-])\d{3}[-.]\d{4}(?![\d-])", True),
    (r"(?<![\w./-])\d{7,13}(?!\d)", True),
    (rf"(?<![\w./-])[6789]\d{{2}}(?:{_S}\d{{2,3}}){{2,3}}(?!\d)", True),
)]
# numbers in groups that are none of the kinds, accounts and cards: no part of one is a telephone number
_BEFORE_NUMBER, _AFTER_NUMBER = 160, 80
_GROUPED = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b|(?<![\w+.-])\d{4}(?:[ -]\d{4}){3}(?![\w-])")
# stretches of signs that hold digits enough for a telephone or identity number
_MANY_DIGITS = re.compile(r"\d(?:[A-Z ()./\n,-]{0,8}\d){3,}")
# results of dice and other ranges: an en dash between small numbers sets no telephone number
_RANGE = re.compile(r"(?<!\d)\d{1,2}\s*–\s*\d{1,2}(?!\d)")
_NO_PHONE = re.compile(r"(?:isbn|product\s+code|item|file|grid|printed|ref\w*|order|code|listed\s+under|table|page|no|nr)[\s.:#]*$", re.I)

# Forms of address, and words that begin names of places.
_HONORIFICS = frozenset("mr mrs ms miss mx dr prof professor sir dame lady lord herr frau monsieur madame mademoiselle mme mlle señor señora sr sra don doña brother sister captain master mistress".split())
_PLACE_WORDS = frozenset("lower upper port bad east west north south new old great little saint st mount lake fort castle the a an in at of to from and or near by for with my her his our".split())
# words with a capital at their start; the class leaves out small Latin letters, other scripts' are told later
_TOKEN = re.compile(r"(?<![^\W\d_])(?<![^\W\d_]['’-])[^\W\d_a-zß-öø-ÿ](?:[^\W\d_]|['’](?=[^\W\d_]{2}))*(?:-[^\W\d_]+)*")
_INITIAL = re.compile(r"[^\W\d_]")


class Names:
    """Listed names, and family names by their parts."""

    def __init__(self, given: set[str], family: set[str], min_family: int = 3) -> None:
        self.given = {x.lower() for x in given if x}
        self.family = {x.lower() for x in family if x}
        endings: Counter[str] = Counter()
        for f in self.family:
            endings.update({f[-k:] for k in range(4, len(f) - 2)})
        # of endings within one another that as many names share, only the longest
        inner = {e[k:] for e, n in endings.items() for k in range(1, len(e) - 3) if endings[e[k:]] <= 1.25 * n}
        self.endings = {e for e, n in endings.items() if n >= min_family and e not in inner}
        self.beginnings: Counter[str] = Counter()
        for f in self.family:
            self.beginnings.update({f[: len(f) - len(e)] for e in self.endings if f.endswith(e)})
        self.lengths = sorted({len(e) for e in self.endings})
        self.known: dict[str, int] = {}

    def family_like(self, token: str) -> int:
        """2: listed or of known parts, 1: of a known ending only, 0: no."""
        found = self.known.get(token)
        if found is None:
            found = min((self._part(p) for p in token.lower().split("-")), default=0)
            if len(self.known) < 200_000:
                self.known[token] = found
        return found

    def _part(self, part: str) -> int:
        if part in self.family:
            return 2
        best = 0
        for n in self.lengths:
            if len(part) - n >= 2 and part[-n:] in self.endings:
                best = max(best, 2 if self.beginnings.get(part[:-n], 0) >= 2 else 1)
        return best


def _names(text: str, names: Names) -> Iterator[tuple[int, int]]:
    tokens = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text)]
    used = -1
    for i, (token, a, b) in enumerate(tokens):
        if not token[0].isupper() or len(token) < 4:
            continue
        strength = names.family_like(token)
        if not strength:
            continue
        j = i - 1
        # initials between given and family name
        while j > used and len(tokens[j][0]) == 1 and tokens[j][0].isupper() and re.fullmatch(r"\.\s+", text[tokens[j][2] : tokens[j + 1][1]]):
            j -= 1
        start = None
        if j > used and _given(tokens[j][0], names, strength, token) and re.fullmatch(r"[^\S\n]*\n?[^\S\n]*", text[tokens[j][2] : tokens[j + 1][1]]):
            start = tokens[j][1]
            while j - 1 > used and tokens[j - 1][0].lower() in names.given and tokens[j - 1][0][0].isupper() and re.fullmatch(r"[^\S\n]*\n?[^\S\n]*|-", text[tokens[j - 1][2] : tokens[j][1]]):
                j -= 1
                start = tokens[j][1]
        if start is not None:
            used = i
            yield start, b
        elif i + 1 < len(tokens) and re.fullmatch(r",[^\S\n]*\n?[^\S\n]*", text[b : tokens[i + 1][1]]):
            other, _, end = tokens[i + 1]
            if other.lower() in names.given and other[0].isupper() or _given(other, names, strength, token):
                used = i + 1
                yield a, end


def _given(word: str, names: Names, strength: int, family: str) -> bool:
    low = word.lower()
    if not word[0].isupper() or low in _HONORIFICS or len(word) < 2:
        return False
    if low in names.given:
        return word.isupper() == family.isupper() or word[1:].islower() or "-" in word
    # not listed: a name as far as nothing speaks against it
    return strength > 0 and low not in _PLACE_WORDS and len(word) > 2 and not names.family_like(word) and word.isupper() == family.isupper()


def _capital_stretches(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of all stretches without words in small letters that hold capitals and a digit."""
    if not _CAPITALS.search(text):
        return
    done = 0
    for a, b in [*(m.span() for m in _SMALL.finditer(text)), (len(text), len(text))]:
        if a - done > 8 and _CAPITALS.search(text, done, a) and _HOUSE.search(text, done, a):
            yield done, a
        done = b


def _number_stretches(t: str) -> list[tuple[int, int]]:
    """Bounds of the stretches around every number of four digits or more, the words before it included.

    Numbers near to each other share a stretch. It reaches ``_BEFORE_NUMBER`` characters back, more than any
    term for an identity number with what may follow it, and over what may follow a number.
    """
    out: list[tuple[int, int]] = []
    for m in _MANY_DIGITS.finditer(t):
        a, b = max(0, m.start() - _BEFORE_NUMBER), min(len(t), m.end() + _AFTER_NUMBER)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def mentions(text: str, names: Names) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all mentions in the source text, in order."""
    view = plain(text)
    t = view.text
    taken: list[tuple[int, int]] = []
    found: list[tuple[str, int, int]] = []

    def add(kind: str | None, a: int, b: int) -> None:
        """Take a span that overlaps none taken before; spans are kept in order."""
        i = bisect_left(taken, (a, b))
        if (i == len(taken) or taken[i][0] >= b) and (i == 0 or taken[i - 1][1] <= a):
            taken.insert(i, (a, b))
            if kind:
                found.append((kind, *view.source(a, b)))

    if "@" in t:
        for m in _EMAIL.finditer(t):
            add("email", m.start(), m.end())
    if _HOUSE.search(t):
        for p, hint in zip(_ADDRESSES, _HINTS, strict=True):
            if hint.search(t):
                for m in p.finditer(t):
                    add("address", *m.span())
        for a, b in _capital_stretches(t):
            for p in _IN_CAPITALS:
                for m in p.finditer(t, a, b):
                    add("address", *m.span())
        stretches = _number_stretches(t)
        for k, p in enumerate(_IDS):
            for a, b in stretches:
                for m in p.finditer(t, a, b):
                    value = m.group(1)
                    if sum(c.isdigit() for c in value) >= (4 if k == 0 else 6):
                        add("id", *m.span(1))
        for a, b in stretches:
            for m in _GROUPED.finditer(t, a, b):
                add(None, *m.span())
        for p, need in _PHONES:
            for a, b in stretches:
                for m in p.finditer(t, a, b):
                    digits = sum(c.isdigit() for c in m.group())
                    before = t[max(0, m.start() - 40) : m.start()]
                    if not 7 <= digits <= 20 or _NO_PHONE.search(before) or (need and not _CALL.search(before)):
                        continue
                    x, y = view.source(*m.span())
                    if _RANGE.search(text, x, y):
                        continue
                    add("phone", *m.span())
    for a, b in _names(t, names):
        add("name", a, b)
    return sorted(found, key=lambda x: x[1])


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each mention replaced by a placeholder of its kind."""
    out, done = [], 0
    for kind, a, b in found:
        if a < done:
            continue
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    out.append(text[done:])
    return "".join(out)


def line_numbers(text: str, starts: list[int]) -> list[int]:
    """1-based number of the line each ascending position lies in."""
    out, line, done = [], 1, 0
    for s in starts:
        line += text.count("\n", done, s)
        done = s
        out.append(line)
    return out


def find_personal(df: DataFrame, known_names: DataFrame, text: str = "text", max_names: int = 100_000) -> DataFrame:
    """``df`` with ``mentions`` (kind, start, end, line_no) and ``redacted``.

    ``known_names`` (name, kind) goes to every task; more than ``max_names`` rows are refused.
    """
    df, renamed = make_room(df, ("mentions", "redacted", "_personal"))
    text = renamed[text]
    listed = known_names.select("name", "kind").where("name is not null").distinct().limit(max_names + 1).collect()
    if len(listed) > max_names:
        raise ValueError(f"more than {max_names} known names")
    given = {r.name for r in listed if r.kind == "given"}
    family = {r.name for r in listed if r.kind == "family"}

    @F.pandas_udf(RESULT)
    def detect(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = Names(given, family)
        for texts in parts:
            spans, clean = [], []
            for t in texts:
                if t is None:
                    spans.append(None)
                    clean.append(None)
                    continue
                found = mentions(t, names)
                lines = line_numbers(t, [a for _, a, _ in found])
                spans.append([{"kind": k, "start": a, "end": b, "line_no": n} for (k, a, b), n in zip(found, lines, strict=True)])
                clean.append(redact(t, found))
            yield pd.DataFrame({"mentions": spans, "redacted": clean})

    detect = detect.asNondeterministic()
    out = df.withColumn("_personal", detect(F.col(text).cast("string")))
    return out.select(*df.columns, F.col("_personal.mentions").alias("mentions"), F.col("_personal.redacted").alias("redacted"))
