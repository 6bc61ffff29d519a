"""Markup residue in text documents (problem 7).

A text is cut into blocks; each block is read with the marks of HTML, Markdown, wiki and TeX that stand in it, and comes out as a heading,
list item, code, formula, table row or paragraph without them. Whole pages go through two passes of block rules: first link density,
length and stop-word density decide blocks as text or as furniture of the site as far as they can; then ambiguous short blocks inherit
the label of the nearest decided neighbours, furniture winning a tie unless both agree on text. Texts that only hold remains keep all their
blocks; those that hold them are found by two passes too (label_blocks): marks, length, stop words and links decide blocks as remains of a kind
or as clean, and ambiguous short blocks inherit from the nearest decided ones.

Clean text: blocks apart by an empty line; headings as a line of their own, list items after "- ", code indented by four blanks, formulas
as their source between dollar signs, table cells apart by a tab.

Defined results: null stays null, empty stays empty; unclosed, broken and escaped tags are read as tags; no length limit; repeated rows
give equal rows; an empty table gives an empty table; columns besides key and text are left out."""

from __future__ import annotations

import bisect
import html
import html.entities
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.scale import table

#: The elements of HTML.
ELEMENTS = """a abbr acronym address applet area article aside audio b base basefont bdi bdo big blockquote body br button canvas caption center cite code col
colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header
hgroup hr html i iframe img input ins kbd label legend li link main map mark math menu meta meter nav noframes noscript object ol optgroup option output p param
picture pre progress q rp rt ruby s samp script search section select slot small source span strike strong style sub summary sup svg table tbody td template
textarea tfoot th thead time title tr track tt u ul var video wbr""".split()
#: Frequent words of the languages at hand, by which running text is told from furniture.
STOP_WORDS = frozenset("""a after all an and any as at be but by could did for from had has have he her his how i if in into is it its more no nor not of on one only or
our she so that the their them then there they this to was we what when who with would you your
aber als auch auf aus bei bis das dass dem den der des die ein eine einer er es für hinter ich im ist mit nach nicht oder sich sie so über um und unter von vor war weil wie zu zum zur zwischen
à après au aux avec car ce cette comme dans de des du elle en est et il je la le les leur lorsque mais ne ou où par pas pour puis quand que qui sa sans se ses son sous sur tandis un une
al ante con cuando de del desde donde el ella en entre era es esta hasta la las lo los más mientras no o para pero por porque que se si sin sobre su sus un una y
ao aos até com como da das de do dos e ela ele em entre era foi mais mas na nas no nos o os ou para pela pelo por porque que quando se sem seu sua um uma
aż bez bo był była choć czy dla do gdy i ich jak jego jej jest kiedy lub na nad nie o od po pod przed przez przy się tak to w we z za ze że
а без был была было в во вот для до если же за и из или их к как когда на не но о он она они от по пока под потому при с со так то у хотя что""".split())  # fmt: skip
_name = "(?:" + "|".join(sorted(ELEMENTS, key=len, reverse=True)) + ")"
#: Entities that are read without their semicolon.
_bare_entities = sorted({n for n in html.entities.html5 if not n.endswith(";") and n.lower() not in ("gt", "lt")} | {"ldquo", "rdquo", "lsquo", "rsquo", "mdash", "ndash", "hellip", "middot", "bull", "lt", "gt"}, key=len, reverse=True)
_tag = rf"<!--.*?(?:-->|$)|<!doctype[^>\n]*>?|<\s?/?\s?{_name}(?:\s+[^<>]*|\s*/)?\s*>|</?{_name}(?:\s[^<>\n]*)?$|</{_name}(?=[\s<])"
_scrap = r"\b(?:class|id|style|href|src|align|target)=(?:\"[^\"\n<>]*\"|'[^'\n<>]*')\s*/?>"
_entity = rf"&(?:amp;)?(?:[a-zA-Z][a-zA-Z0-9]{{1,30}};|\#\d{{1,7}};?|\#[xX][0-9a-fA-F]{{1,6}};?|(?:{'|'.join(_bare_entities)})(?![\w=]))"
# emphasis ends within its paragraph, that is before a blank line; a run of quotes between blanks opens and closes nothing
_inside = r"[^\n{0}]*(?:\n(?!\s*\n)[^\n{0}]*)*"
_quoted = r"(?:[^\n']++|'(?!')|\n(?!\s*\n)|(?<=\s)'{2,}(?=\s)|'{6,})*+"
_formula = r"\$\$[^$]+\$\$|\\\([^\n]*?\\\)|(?<!\\)\\\[(?!\d+(?:pt|em|ex|cm|mm)\])[^\]]*\\\]|\$(?![\s\d])[^$\n]*[\\^_{}=+<>][^$\n]*(?<!\s)\$(?!\d)|\$\d[^$\n]*[\\^_{}=][^$\n]*(?<!\s)\$(?!\d)"
#: The marks of each kind.
MARKS = {
    "html": re.compile(rf"{_tag}|{_scrap}|{_entity}", re.I | re.M),
    "markdown": re.compile(
        r"^[ ]{0,3}={3,}[ \t\r]*$|^[ ]{0,3}(?:```|~~~)|^>[ ]?\S"
        rf"|(?<![\w*\\])\*\*(?=[^\s*]){_inside.format('*')}(?<=[^\s*])\*\*(?!\*)|(?<![\w*\\])\*(?=[^\s*]){_inside.format('*')}(?<=[^\s*])\*(?![\w*])|(?<![\w\\])_(?=[^\W_]|[\"“«'’‘(¿¡]){_inside.format('_')}(?<=[^\s_])_(?!\w)"
        rf"|~~(?=\S){_inside.format('~')}(?<=\S)~~|!?\[[^\]\[]*\]\([^)\s]+(?:\s[^)\n]*)?\)|\[\^[^\]\s]+\]|^\[[^\]\n]+\]:\s|(?<!`)`(?=\S)[^`\n']*(?<=\S)`(?!`)"
        r"|^[ ]{0,3}\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?[ \t\r]*$", re.M),
    "wiki": re.compile(
        rf"(?<!')'{{2,5}}(?=[^\s']){_quoted}(?<=[^\s'])'{{2,5}}(?!')"
        r"|\[\[|\]\]|(?<![\w}\\])\{\{\s*[\w#:]|^\{\||^\|-[ \t\r]*$|^\|\}|^={2,6}[^=\n][^\n]*?={2,6}[ \t\r]*$|^:{1,5}[ ]?\S(?![)(DPp]\s)(?=[^\n]{12})"
        r"|\[https?://[^\s\]]+\s[^\]\n]+\]|</?(?:ref|nowiki|gallery|noinclude|includeonly)\b|^\#REDIRECT|__(?:NO)?TOC__", re.M),
    "latex": re.compile(
        rf"\\(?:begin|end)\s*\{{|\\[a-zA-Z]+\*?\s?(?:\[[^\]\n]*\])?\{{|(?:^|(?<=[\s({{\[$~.,;:!?\"”’»—–-]))(?<![A-Za-z]:)\\(?!\\)[a-zA-Z]{{2,}}\b(?![\\.\w])|\{{\\[a-z]{{2,3}}\b|\\\\(?:\[[^\]\n]*\])?[ \t\r]*$|\\[&%$](?=\W)|^%[ ]|{_formula}|\w_\{{[^}}\n]*\}}|\w\^\{{[^}}\n]*\}}", re.M),
}
KINDS = tuple(MARKS)
_signs = {"html": "<&=", "markdown": "#=`~>*_[|", "wiki": "'[]{|=:<_", "latex": "\\$%{"}
_every_sign = "".join(sorted({c for x in _signs.values() for c in x}))


#: Marks that more than one kind has, with the kinds in order of likelihood: "# " opens a heading or an item of a numbered list.
SHARED = ((re.compile(r"^[ ]{0,3}\#{1,6}[ \t]+\S[^\n]*", re.M), ("markdown", "wiki")),)
_formulas_of = re.compile(_formula)
_words = re.compile(r"[^\W\d_]+")
_links = re.compile(r"\[[^\]\[\n]*\]\([^)\s]+\)|\[\[[^\]\n]*\]\]|<a\s[^<>]*>.*?</a>|https?://\S+", re.I)
#: Running text: so many characters and such a share of stop words; links: such a share of characters.
RUNNING, MUCH, LOW, HIGH, LINKED = 70, 200, 0.2, 0.3, 0.3


def density(text: str) -> float:
    """The share of stop words among the words."""
    words = [w for w in re.split(r"[^\w’']+", text.lower()) if w]
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


class Spans:
    """Spans in order that don't overlap, asked whether they touch another span."""

    def __init__(self, spans):
        self.spans = list(spans)
        self.starts = [a for a, _ in self.spans]

    def touch(self, start: int, end: int) -> bool:
        k = bisect.bisect_left(self.starts, end)
        return k > 0 and self.spans[k - 1][1] > start


@dataclass
class Piece:
    """A block of an extracted text: its first and last line, its text, the lines with marks of its own kinds, and its label: the kinds of markup
    of which it holds remains, none if it is clean, None as long as it is ambiguous."""

    first: int
    last: int
    text: str
    marks: dict[int, set[str]] = field(default_factory=dict)
    shared: tuple[str, ...] = ()
    label: set[str] | None = None


def label_blocks(text: str) -> list[Piece]:
    """The blocks of an extracted text, labelled in two passes. Blocks are paragraphs; a line with a mark that several kinds share is a block.

    Pass 1 decides. Blocks with marks that only one kind has hold its remains; signs within a formula are no marks of Markdown or wiki. Blocks
    without marks are clean if they are running text by length, stop words and links; so are long ones with a shared mark, in which the sign is
    ordinary text. Short blocks with a shared mark are ambiguous.
    Pass 2: an ambiguous block inherits from the nearest decided block of one of its kinds, whatever clean blocks stand between. In a text without
    any, it inherits from clean neighbours if it has no words, as numberings have none; a heading of words takes the likeliest kind."""
    lines = text.split("\n")
    starts = [0]
    for x in lines[:-1]:
        starts.append(starts[-1] + len(x) + 1)
    at = lambda place: bisect.bisect_right(starts, place)
    tex = Spans(m.span() for m in _formulas_of.finditer(text)) if "$" in text or "\\" in text else Spans(())
    own: dict[int, set[str]] = {}
    for kind in KINDS:
        if any(c in text for c in _signs[kind]):
            for m in MARKS[kind].finditer(text):
                if kind in ("html", "latex") or not tex.touch(*m.span()):
                    own.setdefault(at(m.start()), set()).add(kind)
    shared = {at(m.start()): kinds for mark, kinds in SHARED for m in (mark.finditer(text) if "#" in text else ())}
    pieces: list[Piece] = []
    open_ = False
    for n, line in enumerate(lines, 1):
        if not line.strip():
            open_ = False
        elif n in shared:
            pieces.append(Piece(n, n, line, shared=shared[n]))
            open_ = False
        elif open_:
            pieces[-1].last = n
        else:
            pieces.append(Piece(n, n, line))
            open_ = True
    for n, kinds in own.items():
        k = max(0, bisect.bisect_right(pieces, n, key=lambda p: p.first) - 1)
        pieces[k].marks.setdefault(n, set()).update(kinds)
    for p in pieces:
        if p.marks:
            p.label = set().union(*p.marks.values())
        elif p.first < p.last:
            p.text = "\n".join(lines[p.first - 1 : p.last])
        if not p.marks and (len(p.text) >= MUCH or not p.shared):
            linked = sum(m.end() - m.start() for m in _links.finditer(p.text)) if "[" in p.text or "<" in p.text or "://" in p.text else 0
            n = len(p.text)
            if n >= RUNNING and linked <= LINKED * n and density(p.text) >= (HIGH if p.shared else LOW):
                p.label = set()
    if shared:
        of = {k: [i for i, p in enumerate(pieces) if p.label and k in p.label] for k in {k for kinds in shared.values() for k in kinds}}
        for i, p in enumerate(pieces):
            if p.shared and (p.label is None or p.marks and p.label.isdisjoint(p.shared)):
                near = []
                for k in p.shared:
                    x = bisect.bisect_left(of[k], i)
                    near += [(abs(pieces[j].first - p.first), pieces[j].first, k) for j in of[k][max(0, x - 1) : x + 1] if j != i]
                kind = min(near)[2] if near else p.shared[0] if _words.search(p.text) else None
                p.marks.setdefault(p.first, set()).update([kind] if kind else [])
                p.label = set().union(*p.marks.values())
    return pieces


def label_lines(text: str) -> dict[int, set[str]]:
    """Lines with remains of markup and their kinds."""
    return {n: kinds for p in label_blocks(text) for n, kinds in p.marks.items() if kinds}


def kinds_of(text: str) -> list[str]:
    """The kinds of markup of which the text holds marks."""
    if not any(c in text for c in _every_sign):
        return []
    found = set().union(*(p.label or () for p in label_blocks(text)))
    return [k for k in KINDS if k in found]


@dataclass
class Block:
    """A piece of a text: its role, its plain text, how many of its characters are links, and whether it is kept."""

    role: str
    text: str
    links: int = 0
    keep: bool | None = field(default=None)


class _Page(HTMLParser):
    """Reads HTML into blocks."""

    BLOCKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table td th tr ul title br".split())
    SKIPPED = frozenset("head script style template noscript svg object iframe".split())

    def __init__(self, lines: bool):
        super().__init__(convert_charrefs=True)
        self.lines, self.blocks, self.text, self.links = lines, [], [], 0
        self.skip: list[str] = []
        self.role, self.link, self.pre, self.formula = "text", 0, 0, 0

    def close_block(self) -> None:
        raw = "".join(self.text)
        text = raw.strip("\n") if self.role == "code" else " ".join(raw.split())
        if text.strip():
            self.blocks.append(Block(self.role, text, self.links))
        self.text, self.links = [], 0

    def handle_starttag(self, tag, attrs):
        if self.skip:
            return
        if tag in self.SKIPPED:
            self.skip.append(tag)
        elif tag == "body":
            self.skip = []
        if tag in self.BLOCKS:
            self.close_block()
            if tag == "pre":
                self.pre += 1
            if tag != "br":
                self.role = "heading" if re.fullmatch("h[1-6]", tag) else "item" if tag in ("li", "dd") else "code" if tag == "pre" else "cell" if tag in ("td", "th") else "text" if tag in ("p", "div", "blockquote") else self.role
        if tag == "a":
            self.link += 1
        if tag == "math" or ("class", "math") in attrs:
            self.formula += 1
            self.text.append("$")

    def handle_endtag(self, tag):
        if self.skip:
            if tag == self.skip[-1]:
                self.skip.pop()
            return
        if self.formula and tag in ("math", "span"):
            self.formula -= 1
            self.text.append("$")
        if tag in self.BLOCKS:
            self.close_block()
            self.pre -= tag == "pre" and self.pre > 0
            self.role = "text"
        if tag == "a" and self.link:
            self.link -= 1

    def handle_data(self, data):
        if self.skip:
            return
        if self.pre or not self.lines:
            self._add(data)
            return
        for n, line in enumerate(data.split("\n")):
            if n:
                self.close_block()
            self._add(line)

    def _add(self, data: str) -> None:
        self.text.append(data)
        self.links += self.link > 0 and len(data.strip())


def html_blocks(text: str, lines: bool = False) -> list[Block]:
    """Blocks of a page; of a text with remains, each line ends a block. Escaped tags are unescaped first, a second escaping too."""
    for _ in range(2):
        if re.search(rf"&(?:amp;)*(?:lt;|\#60;|\#x3c;)/?{_name}\b", text, re.I) or re.search(r"&amp;(?:\w+|#\w+);", text):
            text = re.sub(r"&amp;(?=#?\w+;)", "&", text)
            text = re.sub(rf"&(?:lt|\#60|\#x3c);(/?{_name}\b[^<>\n]*?)&(?:gt|\#62|\#x3e);", r"<\1>", text, flags=re.I)
    text = re.sub(rf"(</?{_name})(?=\s*$)", r"\1>", text, flags=re.I | re.M)
    page = _Page(lines)
    # a sign that opens no tag is text
    page.feed(re.sub(rf"<(?!/?{_name}\b|!)", "&lt;", text, flags=re.I))
    page.close()
    page.close_block()
    return page.blocks


_md_line = [
    (re.compile(r"!\[([^\]\[]*)\]\([^)\s]+(?:\s[^)\n]*)?\)"), r"\1"), (re.compile(r"\[([^\]\[]*)\]\([^)\s]+(?:\s[^)\n]*)?\)"), r"\1"), (re.compile(r"\[\^[^\]\s]+\]:?"), ""),
    (re.compile(r"\*\*(?=\S)(.+?)(?<=\S)\*\*"), r"\1"), (re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])"), r"\1"),
    (re.compile(r"(?<!\w)_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?!\w)"), r"\1"), (re.compile(r"~~(?=\S)(.+?)(?<=\S)~~"), r"\1"), (re.compile(r"(?<!`)`([^`\n]+)`(?!`)"), r"\1"),
]
_wiki_line = [
    (re.compile(r"\{\{\s*math\s*\|([^{}\n]*)\}\}"), r"$\1$"), (re.compile(r"\{\{[^{}\n]*\}\}"), ""), (re.compile(r"\[\[(?:File|Image|Category):[^\]\n]*\]\]", re.I), ""),
    (re.compile(r"\[\[(?:[^\]\[|\n]*\|)?([^\]\[|\n]*)\]\]"), r"\1"), (re.compile(r"\[https?://\S+\s([^\]\n]+)\]"), r"\1"), (re.compile(r"\[\[|\]\]"), ""),
    (re.compile(r"'{2,5}(?=\S)(.+?)(?<=\S)'{2,5}"), r"\1"), (re.compile(r"</?(?:ref|nowiki|gallery|noinclude|includeonly)\b[^>]*>"), ""),
]
#: Emphasis that may run over line ends, with what it holds.
_md_across = [
    re.compile(rf"(?<![\w*\\])\*\*(?=[^\s*])({_inside.format('*')})(?<=[^\s*])\*\*(?!\*)"), re.compile(rf"(?<![\w*\\])\*(?=[^\s*])({_inside.format('*')})(?<=[^\s*])\*(?![\w*])"),
    re.compile(rf"(?<![\w\\])_(?=[^\W_]|[\"“«'’‘(¿¡])({_inside.format('_')})(?<=[^\s_])_(?!\w)"), re.compile(rf"~~(?=\S)({_inside.format('~')})(?<=\S)~~"),
]
_wiki_across = [re.compile(rf"(?<!')'{{2,5}}(?=[^\s'])({_quoted})(?<=[^\s'])'{{2,5}}(?!')")]
_verbatim = re.compile(r"^\s{0,3}(```+|~~~+).*?(?:^\s*\1|\Z)|\\begin\{(verbatim|lstlisting)\}.*?(?:\\end\{\2\}|\Z)", re.M | re.S)
_tex_line = [
    (re.compile(r"~?\\(?:cite|label|ref|pageref|index|vspace|hspace|input|includegraphics)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}"), ""), (re.compile(r"\\footnote\{([^{}\n]*)\}"), r" (\1)"),
    (re.compile(r"\{\\(?:it|bf|em|sc|rm|tt|sl|large|small)\b\s*([^{}\n]*)\}"), r"\1"), (re.compile(r"\\(?:text\w+|emph|underline|mbox|title|author|date|href\{[^{}]*\}|url)\s?\{([^{}\n]*)\}"), r"\1"),
    (re.compile(r"\\(?:ldots|dots)\b(?:\{\})?"), "…"), (re.compile(r"\\\\(?:\[[^\]\n]*\])?\s*$"), ""), (re.compile(r"\\([&%$#_{}])"), r"\1"),
    (re.compile(r"\\(?:bigskip|medskip|smallskip|noindent|par|newpage|clearpage|maketitle|tableofcontents|centering)\b\s*"), ""),
]


def _formulas(line: str) -> str:
    """Formulas in one style: their source between dollar signs."""
    line = re.sub(r"\$\$([^$]+)\$\$", r"$\1$", line)
    line = re.sub(r"\\\((.+?)\\\)", r"$\1$", line)
    return re.sub(r"(?<!\\)\\\[(?!\d+(?:pt|em|ex|cm|mm)\])(.+?)\\\]", r"$\1$", line)


def _apply(rules, line: str) -> str:
    for _ in range(3):
        new = line
        for rx, to in rules:
            new = rx.sub(to, new)
        if new == line:
            break
        line = new
    return line


def _without_across(text: str, rules: list[re.Pattern]) -> str:
    """The text without the signs of emphasis that runs over line ends; code and formulas stay as they are."""
    for rx in rules:
        for _ in range(3):
            fixed = [Spans(m.span() for m in r.finditer(text)) for r in (_verbatim, _formulas_of)]
            new = rx.sub(lambda m: m[0] if "\n" not in m[0] or any(x.touch(*m.span()) for x in fixed) else m[1], text)  # noqa: B023
            if new == text:
                break
            text = new
    return text


def line_blocks(text: str, kinds: list[str]) -> list[Block]:
    """Blocks of Markdown, wiki and TeX, which mark them by lines."""
    out: list[Block] = []
    md, wiki, tex = ("markdown" in kinds), ("wiki" in kinds), ("latex" in kinds)
    fence, wikitable = "", False
    text = _without_across(text.replace("\r\n", "\n"), (_md_across if md else []) + (_wiki_across if wiki else []))
    for line in text.split("\n"):
        bare = line.strip()
        if fence:
            if bare.startswith(fence):
                fence = ""
            else:
                out.append(Block("code", line.rstrip()))
            continue
        if md and (m := re.match(r"\s{0,3}(```+|~~~+)", line)):
            fence = m.group(1)
            continue
        if tex and (m := re.match(r"\s*\\begin\{(verbatim|lstlisting)\}", line)):
            fence = rf"\end{{{m.group(1)}}}"
            continue
        if not bare:
            out.append(Block("gap", ""))
            continue
        if wiki and bare.startswith("{|"):
            wikitable = True
            continue
        if wikitable:
            wikitable = not bare.startswith("|}")
            cells = [c.split("|")[-1].strip() for c in re.split(r"\|\||!!", bare.lstrip("|!"))] if bare[:2] not in ("|-", "|}", "|+") else []
            if any(cells):
                out.append(Block("cell", "\t".join(cells)))
            continue
        if md and re.fullmatch(r"={3,}", bare):
            if out and out[-1].role == "gap":
                out.pop()
            if out and out[-1].role == "text":
                out[-1].role = "heading"
            continue
        if md and re.fullmatch(r"\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?", bare):
            continue
        role, body = "text", line if line.startswith(("    ", "\t")) else bare
        if md and (m := re.match(r"#{1,6}\s+(.*?)\s*#*$", bare)):
            role, body = "heading", m.group(1)
        elif wiki and (m := re.match(r"={2,6}\s*([^=].*?)\s*={2,6}$", bare)):
            role, body = "heading", m.group(1)
        elif tex and (m := re.match(r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?(?:\[[^\]]*\])?\{(.*?)\}\s*(?:\\label\{[^{}]*\})?$", bare)):
            role, body = "heading", m.group(1)
        elif tex and bare.startswith("% "):
            continue
        elif tex and (m := re.match(r"\\item\b(?:\[[^\]]*\])?\s*(.*)", bare)):
            role, body = "item", m.group(1)
        elif tex and re.fullmatch(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\]|\{[^{}]*\})*", bare):
            continue
        elif (md or wiki) and (m := re.match(r"(?:[*+#]{1,4}|:{1,5}(?=\s?\S)|;)\s+(\S.*)", bare)) and not re.fullmatch(r"[*#~\s-]+", bare):
            role, body = "item", m.group(1)
        elif md and (m := re.match(r">\s?(.*)", bare)):
            body = m.group(1)
        elif md and re.fullmatch(r"\|.*\|", bare):
            role, body = "cell", "\t".join(c.strip() for c in bare.strip("|").split("|"))
        body = _formulas(body)
        parts = re.split(r"(\$[^$\n]+\$)", body)
        for i in range(0, len(parts), 2):  # a formula's source stays as it is
            for on, rules in ((tex, _tex_line), (wiki, _wiki_line), (md, _md_line)):
                if on:
                    parts[i] = _apply(rules, parts[i])
        body = "".join(parts)
        if body.strip():
            out.append(Block("formula" if re.fullmatch(r"\$[^$]+\$", body.strip()) else role, body))
    return out


def judge(blocks: list[Block], least: int = RUNNING, much: int = MUCH, low: float = LOW, high: float = HIGH, link: float = LINKED) -> None:
    """Labels a page's blocks in two passes.

    Pass 1, in characters: mostly links -> furniture; code, formulas and table rows -> text; shorter than `least` -> ambiguous; longer with
    many stop words -> text; with few -> furniture, ambiguous in between or if shorter than `much`.
    Pass 2: each ambiguous block takes the label of its nearest decided neighbours; where they differ, the nearer one's, furniture if equally
    near; a heading takes the label of the first decided block behind it. Without any decided block all are text."""
    first: list[bool | None] = []
    for b in blocks:
        n = len(b.text)
        dense = density(b.text)
        if b.links > link * n:
            first.append(False)
        elif b.role in ("code", "formula", "cell"):
            first.append(True)
        elif "©" in b.text or n < least or b.role == "heading":
            first.append(False if "©" in b.text and n < much else None)
        elif dense >= high or (dense >= low and n >= least):
            first.append(True)
        else:
            first.append(None if n < much or dense >= low / 2 else False)
    n = len(blocks)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        before[i] = last
        if first[i] is not None:
            last = i
    last = None
    for i in reversed(range(n)):
        after[i] = last
        if first[i] is not None:
            last = i
    for i, b in enumerate(blocks):
        x, y = before[i], after[i]
        if first[i] is not None:
            b.keep = first[i]
        elif x is None and y is None:
            b.keep = True
        elif b.role == "heading" and y is not None:
            b.keep = first[y]
        elif x is None or y is None:
            b.keep = first[y if x is None else x]
        elif first[x] == first[y]:
            b.keep = first[x]
        else:
            b.keep = first[x] if i - x < y - i else first[y] if y - i < i - x else False


def written(blocks: list[Block]) -> str:
    """The clean text of the kept blocks."""
    out: list[str] = []
    last = ""
    for b in blocks:
        if b.keep is False:
            continue
        if b.role == "gap":
            last = "gap"
            continue
        text = {"item": "- " + b.text, "code": "\n".join("    " + x for x in b.text.split("\n"))}.get(b.role, b.text)
        close = b.role == last and b.role in ("code", "item", "cell")
        out.append(("" if not out else "\n" if close else "\n\n") + text)
        last = b.role
    return "".join(out)


def clean_page(body: str) -> tuple[str, str, int]:
    """Kind, clean text and number of dropped blocks of a whole page. The body tells its kind; the declared type may be wrong."""
    kinds = kinds_of(body)
    if re.search(r"<(?:!doctype|html|body|p|div)\b", body, re.I):
        blocks = html_blocks(body)
        judge(blocks)
        return "html", written(blocks), sum(b.keep is False for b in blocks)
    kind = max((k for k in kinds), key=lambda k: len(MARKS[k].findall(body)), default="text")
    return kind, written(line_blocks(body, kinds)), 0


def clean_text(text: str) -> tuple[str, list[str]]:
    """The text without remains of markup, and their kinds; a text without any comes back unchanged."""
    kinds = kinds_of(text)
    if not kinds:
        return text, kinds
    rest = [k for k in kinds if k != "html"]
    if "html" in kinds:
        parts, verbatim = [], re.split(r"((?:^|\n)\s*```.*?\n\s*```[^\n]*)", text, flags=re.S)
        for n, part in enumerate(verbatim):
            if n % 2 or not MARKS["html"].search(part):
                parts.append(part)
            else:
                parts.append("\n\n".join(("- " if b.role == "item" else "") + b.text for b in html_blocks(part, lines=True)))
        text = "\n\n".join(p.strip("\n") for p in parts if p.strip())
        if not rest:
            return text, kinds
    return written(line_blocks(text, rest)), kinds


def _map(df: DataFrame, key: str, text: str, schema: str, of) -> DataFrame:
    """key and the fields that `of` makes of each text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pylist([{"_key": k.as_py(), **r} for k, r in zip(batch.column(0), rows, strict=True)], schema=_arrow(batch.schema.field(0).type, schema))

    return df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(run, f"_key {kind}, {schema}").withColumnRenamed("_key", key)


def _arrow(key, schema: str):
    kinds = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
    return pa.schema([("_key", key), *((n, kinds[t]) for n, t in (x.strip().split(" ") for x in schema.split(", ")))])


def find_markup(df: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key and kinds of the texts that hold remains of markup."""
    return _map(df, key, text, "kinds array<string>", lambda t: {"kinds": kinds_of(t) if t else []}).filter(F.size("kinds") > 0)


def clean_texts(df: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, clean text and kinds of every text."""

    def of(t):
        new, kinds = clean_text(t) if t else (t, [])
        return {"clean": new, "kinds": kinds}

    return _map(df, key, text, "clean string, kinds array<string>", of)


def clean_pages(df: DataFrame, key: str = "raw_path", text: str = "body") -> DataFrame:
    """key, kind, clean text and dropped blocks of every page."""

    def of(t):
        kind, new, dropped = clean_page(t) if t else (None, t, 0)
        return {"kind": kind, "clean": new, "dropped": dropped}

    return _map(df, key, text, "kind string, clean string, dropped int", of)


def p7_found(spark, d):
    return find_markup(table(spark, d, "files")).select(F.col("path").alias("text_path"), F.explode("kinds").alias("markup"))


def p7_texts(spark, d):
    """Every extracted text without remains."""
    return clean_texts(table(spark, d, "files")).withColumnRenamed("path", "text_path")


def p7_blocks(spark, d):
    """How the blocks of every extracted text are labelled: as clean, as holding remains, or not at all (short ones without marks)."""

    def of(t):
        pieces = label_blocks(t) if t else []
        return {"clean": sum(p.label == set() for p in pieces), "marked": sum(bool(p.label) for p in pieces), "undecided": sum(p.label is None for p in pieces)}

    return _map(table(spark, d, "files"), "path", "text", "clean int, marked int, undecided int", of).withColumnRenamed("path", "text_path")


def p7_pages(spark, d):
    """Every fetched page as clean text."""
    return clean_pages(table(spark, d, "raws"))


QUERIES = {"p7_found": p7_found, "p7_texts": p7_texts, "p7_blocks": p7_blocks, "p7_pages": p7_pages}
