"""Visually identical text with different characters (problem 10).

A character is stable if it can't change or take part in a change: the quick check of the Unicode normal forms gives that by
character. A text of stable characters passes through untouched. In other texts the unstable segments are isolated, each with the
stable character before it and the marks behind it as boundary context; only these segments are normalised, and the results are
spliced between the unchanged parts. Words that mix scripts are brought to the script of most of their letters by look-alikes.

The consistent form: composed (NFC); compatibility forms of letters, digits, signs and ligatures resolved (NFKC) but for the
ellipsis and other punctuation that is no case; every space a plain one; no invisible characters outside emoji; a letter of another
script inside a word replaced by its look-alike. Tabs, line ends, quotes, dashes and whole words of another script stay.

Defined results: null stays null, empty stays empty; no length limit; the form is idempotent; repeated rows give equal rows; an
empty table gives an empty table; a further column with the result's name gives way to it."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata as U

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.scale import table

#: Look-alikes. Cyrillic and Greek letters, each over the Latin one of the same look.
CYRILLIC = "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһӏԛԝҮүѵ"
CYRILLIC_AS_LATIN = "ABESIJKMHOPCTYXaesijopcyxdhlqwYyv"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχγϲϳ"
GREEK_AS_LATIN = "ABEZHIKMNOPTYXaikvoptuxycj"
#: Cyrillic letters over the Greek ones of the same look.
CYRILLIC_FOR_GREEK = "АВЕЗНІКМОРТУХоріхν"
GREEK_FOR_CYRILLIC = "ΑΒΕΖΗΙΚΜΟΡΤΥΧοριχν"
_JOINER, _KEYCAP, _SELECTORS = "‍", "\u20e3", {chr(c) for c in range(0xFE00, 0xFE10)}


def _invisible(c: str) -> bool:
    """Format characters but for those that print (signs of Arabic numbers and the like), variation selectors and fillers."""
    n = ord(c)
    if U.category(c) == "Cf":
        return not (0x600 <= n <= 0x605 or n in (0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD) or 0x13430 <= n <= 0x1343F)
    return c in _SELECTORS or n in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x2800) or 0x180B <= n <= 0x180F or 0xE0100 <= n <= 0xE01EF


def _keeps(c: str) -> bool:
    """Compatibility forms that are no case: dashes, quotes, the ellipsis and other punctuation or spacing accents."""
    plain = U.normalize("NFKC", c)
    return plain == c or U.category(c)[0] == "P" and not _wide(c) or c in "´¨¯¸˘˙˚˛˜˝"


def _wide(c: str) -> bool:
    return U.decomposition(c).split(" ")[0] in ("<wide>", "<narrow>", "<small>", "<vertical>")


def _ranges(chars: list[int]) -> str:
    out, start = [], None
    for a, b in zip(chars, [*chars[1:], -9], strict=True):
        start = a if start is None else start
        if b != a + 1:
            out.append(f"\\U{start:08x}" + (f"-\\U{a:08x}" if a != start else ""))
            start = None
    return "".join(out)


@functools.lru_cache(maxsize=1)
def _sets() -> dict[str, frozenset[str]]:
    """The unstable characters, from the properties of each code point: marks that compose, compatibility forms, spaces, invisible ones."""
    marks, compat, spaces, hidden = [], [], [], []
    for n in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= n < 0xE000 or 0x20000 <= n < 0x2F800 or 0x30000 <= n < 0xE0000 or 0xE0200 <= n:
            continue
        c = chr(n)
        kind = U.category(c)
        if kind == "Cn" or kind == "Co":
            continue
        if _invisible(c):
            hidden.append(c)
        elif kind == "Zs":
            spaces.append(c)
        elif kind[0] == "M" or 0x1161 <= n <= 0x1175 or 0x11A8 <= n <= 0x11C2:  # vowels and finals of Hangul compose as marks do
            marks.append(c)
        elif not U.is_normalized("NFC", c) or not _keeps(c):
            compat.append(c)
    return {"marks": frozenset(marks), "compat": frozenset(compat), "spaces": frozenset(spaces), "hidden": frozenset(hidden), "all": frozenset([*marks, *compat, *spaces, *hidden])}


#: Fixed value: what is drawn as emoji, with skin tones and flags; a joiner or selector next to one belongs to it.
_emoji = re.compile("[\U0001f000-\U0001faff\u2190-\u21ff\u2300-\u23ff\u24c2\u25a0-\u27bf\u2900-\u297f\u2b00-\u2bff\u3030\u303d\u3297\u3299\u00a9\u00ae\u2122\u203c\u2049\u21390-9#*\u200d\ufe0f\u20e3\U000e0020-\U000e007f]")


def _class(chars) -> str:
    return _ranges(sorted(map(ord, chars)))


@functools.lru_cache(maxsize=10_000)
def _unstable(found: frozenset[str]):
    """Finds the unstable segments of a text that has just these unstable characters: a short class is searched fast."""
    s = _sets()
    turning = found & (s["marks"] | s["compat"])
    alone = found & s["spaces"]
    hidden = found & s["hidden"]
    parts = []
    if turning:
        parts.append(f"[^\\s{_class(found)}]?[{_class(turning)}]+")
    if alone:
        parts.append(f"[{_class(alone)}]")
    if hidden:
        parts.append(f"[{_class(hidden)}]+")
    return re.compile("|".join(parts))


@functools.lru_cache(maxsize=10_000)
def _words(marks: frozenset[str]):
    return re.compile(f"[^\\W\\d_](?:[^\\W\\d_]|[{_class(marks)}])*" if marks else "[^\\W\\d_]+")


#: Letters that stand beside any script without being taken for another letter.
_ANY = ("COMMON", "COMBINING", "EAST")


@functools.lru_cache(maxsize=100_000)
def script(c: str) -> str:
    """The script of a letter: the first word of its name, Latin for the forms made from Latin letters."""
    if c < "ʰ":
        return "LATIN"
    n = ord(c)
    if 0x370 <= n <= 0x3FF or 0x1F00 <= n <= 0x1FFF:
        return "GREEK"
    if 0x400 <= n <= 0x52F or 0x1C80 <= n <= 0x1C8F or 0x2DE0 <= n <= 0x2DFF or 0xA640 <= n <= 0xA69F:
        return "CYRILLIC"
    first = U.name(c, "?").split(" ")[0]
    if first in ("HIRAGANA", "KATAKANA", "CJK", "HANGUL", "BOPOMOFO", "KATAKANA-HIRAGANA", "IDEOGRAPHIC"):
        return "EAST"
    return "COMMON" if first in ("MODIFIER", "?", "SUPERSCRIPT") else first


@functools.lru_cache(maxsize=1)
def _looks() -> dict[tuple[str, str], dict[str, str]]:
    a = dict(zip(CYRILLIC, CYRILLIC_AS_LATIN, strict=True))
    g = dict(zip(GREEK, GREEK_AS_LATIN, strict=True))
    cg = dict(zip(CYRILLIC_FOR_GREEK, GREEK_FOR_CYRILLIC, strict=True))
    return {
        ("CYRILLIC", "LATIN"): a, ("GREEK", "LATIN"): g, ("CYRILLIC", "GREEK"): cg,
        ("LATIN", "CYRILLIC"): {v: k for k, v in reversed(a.items())}, ("LATIN", "GREEK"): {v: k for k, v in reversed(g.items())},
        ("GREEK", "CYRILLIC"): {v: k for k, v in reversed(cg.items())},
    }


def one_script(word: str) -> str:
    """The word with letters of other scripts replaced by look-alikes of the script that most of its letters have.

    At a tie the script that can stand for the whole word wins, then the first letter's. Accents of a letter are kept."""
    kinds: dict[str, int] = {}
    for c in word:
        k = script(c)
        if k not in _ANY:
            kinds[k] = kinds.get(k, 0) + 1
    if len(kinds) < 2:
        return word

    def turned(to: str) -> tuple[str, int]:
        out, missing = [], 0
        for c in word:
            k = script(c)
            if k == to or k in _ANY:
                out.append(c)
                continue
            table_ = _looks().get((k, to), {})
            base, rest = (U.normalize("NFD", c)[0], U.normalize("NFD", c)[1:])
            new = table_.get(c) or (table_.get(base, "") and table_[base] + rest)
            missing += not new
            out.append(new or c)
        return "".join(out), missing

    first = script(word[0])
    best = max(kinds, key=lambda k: (kinds[k], -turned(k)[1], k == first, k))
    return U.normalize("NFC", turned(best)[0])


def mixed(word: str) -> bool:
    return len({script(c) for c in word} - {*_ANY}) > 1


def _hidden(run: str, before: str, after: str, reasons: set | None) -> str:
    """What stays of a run of invisible characters: joiners and selectors that belong to an emoji."""
    out = ""
    for n, c in enumerate(run):
        nxt = run[n + 1 : n + 2] or after
        drawn = bool(before) and bool(_emoji.match(before))
        if before in "0123456789#*":
            drawn = drawn and c in _SELECTORS and nxt == _KEYCAP
        if drawn and (c in _SELECTORS or ord(c) >= 0xE0020 or c == _JOINER and nxt and _emoji.match(nxt) and nxt not in "0123456789#*"):
            out += c
            before = c
        elif reasons is not None:
            reasons.add("invisible")
    return out


def _segment(m: re.Match, text: str, reasons: set | None) -> str:
    s, sets = m.group(), _sets()
    if s[0] in sets["hidden"]:
        return _hidden(s, text[: m.start()][-1:], text[m.end() : m.end() + 1], reasons)
    if s in sets["spaces"]:
        if reasons is not None:
            reasons.add("space")
        return " "
    new = U.normalize("NFC", s)
    if new != s and reasons is not None:
        reasons.add("accent" if sets["marks"].intersection(s) else "compatibility")
    if sets["compat"].isdisjoint(new):
        return new
    if reasons is not None:
        reasons.add("compatibility")
    # the plain form of one character may be another that isn't plain yet, as with a wide ideographic space
    return U.normalize("NFC", "".join(U.normalize("NFKC", c).replace("\u2044", "/") if c in sets["compat"] else c for c in new))


#: Letters of the three scripts that share looks, as classes.
_LATIN, _GREEK, _CYRILLIC = "A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1eff", "\u0370-\u03ff\u1f00-\u1fff", "\u0400-\u052f\u1c80-\u1c8f\ua640-\ua69f"
_border = re.compile(f"[{_LATIN}][{_GREEK}{_CYRILLIC}]|[{_GREEK}][{_LATIN}{_CYRILLIC}]|[{_CYRILLIC}][{_LATIN}{_GREEK}]")


def consistent(text: str, reasons: set | None = None) -> str:
    """The one form of a text; reasons gets the kinds of change it needed."""
    if text.isascii():
        return text
    chars = set(text)
    found = chars & _sets()["all"]
    while found:
        new = _unstable(frozenset(found)).sub(lambda m, t=text: _segment(m, t, reasons), text)
        if new == text:
            break
        # a mark may now stand behind a letter that an invisible character kept apart from it
        text, chars = new, set(new)
        found = chars & _sets()["all"]
    scripts = {script(c) for c in chars if c.isalpha()} - {*_ANY}
    if len(scripts) < 2:
        return text
    marks = frozenset(chars & _sets()["marks"])
    if scripts <= {"LATIN", "GREEK", "CYRILLIC"} and not marks and not _border.search(text):
        return text

    def word(m):
        w = m.group()
        if w.isascii() or not mixed(w):
            return w
        if reasons is not None:
            reasons.add("script")
        return one_script(w)

    return _words(marks).sub(word, text)


def canonical(df: DataFrame, text: str = "text", out: str = "text", reasons: str | None = None) -> DataFrame:
    """df with text in its one consistent form as out, and the sorted kinds of change as an array if a column is named for them."""
    keep = [c for c in df.columns if c not in (out, reasons)]
    narrow = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_in"))
    fields = [T.StructField(out, T.StringType())] + ([T.StructField(reasons, T.ArrayType(T.StringType()))] if reasons else [])
    schema = T.StructType([*narrow.schema.fields[:-1], *fields])
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            new, why = [], []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                found: set[str] = set()
                new.append(None if t is None else consistent(t, found))
                why.append(sorted(found))
            columns = [*batch.columns[:-1], pa.array(new, pa.string())] + ([pa.array(why, pa.list_(pa.string()))] if reasons else [])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow.mapInArrow(run, schema)


def p10_found(spark, d):
    return canonical(table(spark, d, "documents").select("doc_id", "text"), reasons="_why").filter(F.size("_why") > 0).select("doc_id")


def p10_texts(spark, d):
    """Each text in its consistent form, with what it needed."""
    return canonical(table(spark, d, "documents").select("doc_id", "text"), reasons="needed")


QUERIES = {"p10_found": p10_found, "p10_texts": p10_texts}
