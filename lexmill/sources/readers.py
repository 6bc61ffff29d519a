"""Readers of the workbench: text files, JSON lines, tables, books, scanned pages. Bad input becomes a row with a reason, not a failure."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_SCHEMA = "path string, size long, mtime timestamp, text string, reason string"
MOST_BYTES = 67_108_864


def glob_pattern(glob: str) -> str:
    """A glob as an anchored pattern: * within a folder, ? one character, **/ any folders."""
    out, i = "", 0
    while i < len(glob):
        if glob[i : i + 3] == "**/":
            out, i = out + "(?:.*/)?", i + 3
        elif glob[i : i + 2] == "**":
            out, i = out + ".*", i + 2
        else:
            c = glob[i]
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)), i + 1
    return f"^{out}$"


def decoded(raw: bytes | None, most: int = MOST_BYTES) -> tuple[str | None, str | None]:
    """Text or the reason why there is none."""
    if raw is None or len(raw) > most:
        return None, "too large"
    if not raw:
        return None, "empty"
    if b"\0" in raw:
        return None, "binary"
    try:
        text = raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return None, "not utf-8"
    return (text, None) if re.search(r"\w", text) else (None, "no words")


def read_texts(spark: SparkSession, folder: str, glob: str = "**/*.txt", most: int = MOST_BYTES) -> DataFrame:
    """The files of a folder that match the glob, strictly decoded. Contents beyond `most` bytes aren't read.

    Spark's file reader doesn't hand on files of no bytes; they are to be told by a listing."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    base = "file:" + folder.rstrip("/") + "/" if "://" not in folder else folder.rstrip("/") + "/"
    rel = F.regexp_replace("path", "^" + re.escape(base).replace("file:", "file:/*(?=/)"), "")
    found = raw.select(rel.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.when(F.col("length") <= most, F.col("content")).alias("content")).filter(F.col("path").rlike(glob_pattern(glob)))

    def run(batches):
        for b in batches:
            texts = [decoded(None if x is None else bytes(x), most) for x in b["content"]]
            yield pd.DataFrame({"path": b["path"], "size": b["size"], "mtime": b["mtime"], "text": [t for t, _ in texts], "reason": [r for _, r in texts]})

    return found.mapInPandas(run, FILE_SCHEMA)


def read_jsonl(spark: SparkSession, path: str, text_field: str = "text", id_field: str = "id") -> DataFrame:
    """id, text, reason of each line; a line that is no JSON object or lacks text has a reason."""
    schema = T.StructType([T.StructField(id_field, T.StringType()), T.StructField(text_field, T.StringType()), T.StructField("_bad", T.StringType())])
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    reason = F.when(F.col("_bad").isNotNull(), "bad json").when(F.col(text_field).isNull(), "no text").when(F.trim(text_field) == "", "empty")
    return df.select(F.col(id_field).alias("id"), F.col(text_field).alias("text"), reason.alias("reason"))


def read_table(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """A small table of text columns with a header."""
    return spark.read.option("header", "true").option("sep", separator).option("inferSchema", "false").csv(path)


def changed(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that are new or whose size or time differ from what is known: all that has to be read again."""
    k = known.select("path", F.col("size").alias("_s"), F.col("mtime").alias("_m"))
    return listing.join(k, "path", "left").filter("_s IS NULL OR _s <> size OR _m <> mtime").drop("_s", "_m")


def vanished(listing: DataFrame, known: DataFrame, complete: bool) -> DataFrame:
    """Known files that the listing lacks; none if the listing isn't complete."""
    gone = known.select("path").join(listing.select("path"), "path", "left_anti")
    return gone if complete else gone.limit(0)


def settled(listing: DataFrame, seconds: int = 90) -> DataFrame:
    """Files that haven't been written to for that long, by the clock of the run."""
    return listing.filter(F.col("mtime") < F.current_timestamp() - F.make_interval(secs=F.lit(seconds)))


#: What files of each kind begin with.
MAGIC = ((b"PK\x03\x04", "zip"), (b"%PDF-", "pdf"), (b"\x1f\x8b", "gzip"), (b"\x89PNG", "png"), (b"\xff\xd8\xff", "jpeg"), (b"Rar!", "rar"), (b"{\\rtf", "rtf"), (b"\xd0\xcf\x11\xe0", "ole"))


def sniff(raw: bytes) -> str:
    """The kind of a file by its first bytes."""
    for magic, kind in MAGIC:
        if raw.startswith(magic):
            return "epub" if kind == "zip" and b"application/epub+zip" in raw[:120] else kind
    if raw[60:68] in (b"BOOKMOBI", b"TEXtREAd"):
        return "mobi"
    head = raw[:512].lstrip().lower()
    return "html" if head.startswith((b"<!doctype html", b"<html")) else "binary" if b"\0" in raw[:4096] else "text"


def read_plain(raw: bytes) -> str:
    """Plain text in the first encoding that fits: UTF-8, Windows, Latin-1."""
    for codec in ("utf-8-sig", "cp1252", "latin-1"):
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 decodes everything")


def palm_unpacked(raw: bytes) -> bytes:
    """PalmDOC compression undone: literals, blanks before letters, and pairs of distance and length."""
    out, i = bytearray(), 0
    while i < len(raw):
        b = raw[i]
        i += 1
        if b == 0 or 9 <= b <= 0x7F:
            out.append(b)
        elif b <= 8:
            out += raw[i : i + b]
            i += b
        elif b >= 0xC0:
            out += bytes([0x20, b ^ 0x80])
        else:
            if i >= len(raw):
                break
            pair = b << 8 | raw[i]
            i += 1
            back, size = pair >> 3 & 0x7FF, (pair & 7) + 3
            if not 0 < back <= len(out):
                raise ValueError("distance beyond the text")
            for _ in range(size):
                out.append(out[-back])
    return bytes(out)


def mobi_text(raw: bytes) -> str:
    """The markup of a MOBI book without encryption, stored plain or by PalmDOC compression."""
    count = int.from_bytes(raw[76:78], "big")
    starts = [int.from_bytes(raw[78 + 8 * k : 82 + 8 * k], "big") for k in range(count)] + [len(raw)]
    head = raw[starts[0] : starts[1]]
    how, pages, locked = (int.from_bytes(head[a : a + 2], "big") for a in (0, 8, 12))
    if locked or how not in (1, 2):
        raise ValueError("encrypted" if locked else f"compression {how}")
    codec = "utf-8" if head[16:20] == b"MOBI" and int.from_bytes(head[28:32], "big") == 65001 else "cp1252"
    records = [raw[starts[k] : starts[k + 1]] for k in range(1, min(pages, count - 1) + 1)]
    return b"".join(palm_unpacked(r) if how == 2 else r for r in records).decode(codec, "replace")


_pdf_escapes = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}
_pdf_token = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+]?[0-9]*\.?[0-9]+|/[^\s/<>\[\]()]+|[A-Za-z'\"*]+", re.S)


def _pdf_string(t: bytes) -> str:
    if t[:1] == b"<":
        digits = re.sub(rb"\s", b"", t[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = re.sub(rb"\\([0-7]{1,3})", lambda m: bytes([int(m.group(1), 8) & 255]), t[1:-1])
        raw = re.sub(rb"\\(\r?\n|.)", lambda m: _pdf_escapes.get(m.group(1), b"" if m.group(1)[-1:] == b"\n" else m.group(1)), raw, flags=re.S)
    return raw.decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")


def pdf_text(raw: bytes) -> str:
    """The text that a PDF's content streams show, plain or deflated, for fonts of a standard encoding; a line for each move to a new one.

    Encrypted files and fonts with glyph numbers of their own give no text."""
    out: list[str] = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", raw, re.S):
        data = m.group(1)
        try:
            data = zlib.decompressobj().decompress(data)
        except zlib.error:
            pass
        for block in re.findall(rb"\bBT\b(.*?)\bET\b", data, re.S):
            stack: list[bytes] = []
            for t in _pdf_token.findall(block):
                if t in (b"Tj", b"'", b'"', b"TJ"):
                    if t in (b"'", b'"'):
                        out.append("\n")
                    for x in stack:
                        if x[:1] in b"(<":
                            out.append(_pdf_string(x))
                        elif t == b"TJ" and re.fullmatch(rb"-[0-9.]+", x) and float(x) < -200:
                            out.append(" ")
                    stack = []
                elif t in (b"Td", b"TD", b"T*", b"Tm"):
                    out.append("\n")
                    stack = []
                elif t[:1].isalpha():
                    stack = []
                else:
                    stack.append(t)
            out.append("\n")
    return re.sub(r"[ \t]*\n\s*", "\n", "".join(out)).strip()


class _Text(HTMLParser):
    BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 li br tr blockquote section".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.title, self.skip, self.in_head = [], "", 0, False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "head")
        if tag in self.BLOCKS:
            self.out.append("\n")
        self.in_head = self.in_head or tag in ("h1", "h2", "h3") and not self.title

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "head") and self.skip > 0
        if tag in self.BLOCKS:
            self.out.append("\n")
        if tag in ("h1", "h2", "h3"):
            self.in_head = False

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)
            if self.in_head:
                self.title += data


def _page(markup: str) -> tuple[str, str]:
    p = _Text()
    p.feed(markup)
    p.close()
    lines = (" ".join(x.split()) for x in "".join(p.out).split("\n"))
    return " ".join(p.title.split()), "\n".join(x for x in lines if x)


def epub_sections(raw: bytes) -> list[dict]:
    """The pages of an EPUB in reading order: its package names them, the navigation labels them."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    container = ElementTree.fromstring(z.read("META-INF/container.xml"))
    opf = next(e.get("full-path") for e in container.iter() if local(e) == "rootfile")
    package = ElementTree.fromstring(z.read(opf))
    base = posixpath.dirname(opf)
    items = {e.get("id"): e for e in package.iter() if local(e) == "item"}
    spine = [e.get("idref") for e in package.iter() if local(e) == "itemref"]
    title = next((e.text for e in package.iter() if local(e) == "title"), None)
    author = next((e.text for e in package.iter() if local(e) == "creator"), None)
    labels: dict[str, str] = {}
    for e in items.values():
        if "nav" in (e.get("properties") or "").split():
            href = posixpath.normpath(posixpath.join(base, e.get("href")))
            for a, label in re.findall(r'<a[^>]*href="([^"#]*)[^"]*"[^>]*>(.*?)</a>', z.read(href).decode("utf-8", "replace"), re.S):
                labels.setdefault(posixpath.normpath(posixpath.join(posixpath.dirname(href), a)), re.sub("<[^>]+>", "", label).strip())
    out = []
    for n, ref in enumerate(spine):
        href = posixpath.normpath(posixpath.join(base, items[ref].get("href")))
        markup = z.read(href).decode("utf-8", "replace")
        kind = re.search(r'epub:type="([^"]+)"', markup)
        heading, text = _page(markup)
        out.append({"n": n, "href": href, "label": labels.get(href), "epub_type": kind.group(1) if kind else None, "heading": heading, "text": text, "book": title, "author": author})
    return out


def read_books(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each section of the EPUB, MOBI, PDF, plain-text and HTML books of a folder; a book that can't be read has one row with a reason."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    schema = "path string, n int, href string, label string, epub_type string, heading string, text string, book string, author string, kind string, reason string"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                content = bytes(content)
                kind = sniff(content)
                try:
                    if kind == "epub":
                        found = epub_sections(content)
                    elif kind == "text":
                        found = [{"n": 0, "text": read_plain(content)}]
                    elif kind == "pdf":
                        text = pdf_text(content)
                        found = [{"n": 0, "text": text} if text else {"n": 0, "reason": "no text in the PDF"}]
                    elif kind in ("html", "mobi"):
                        heading, text = _page(mobi_text(content) if kind == "mobi" else read_plain(content))
                        found = [{"n": 0, "heading": heading, "text": text}]
                    else:
                        found = [{"n": 0, "reason": f"no reader for {kind}"}]
                except (KeyError, IndexError, ValueError, StopIteration, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    found = [{"n": 0, "reason": f"broken: {type(e).__name__}"}]
                rows += [{"path": path, "kind": kind, **x} for x in found]
            out = pd.DataFrame(rows, columns=names).astype(object)
            yield out.where(out.notna(), None)

    return raw.mapInPandas(run, schema)


def scanned_pages(pages: DataFrame, book: str = "book", page: str = "page", text: str = "text", heads: int = 3) -> DataFrame:
    """book and text of scanned pages in order: without page numbers and running heads (first lines that `heads` pages share), broken words joined."""
    lines = pages.select(book, page, F.posexplode(F.split(text, "\n")).alias("n", "line"))
    first = lines.filter("n = 0").groupBy(book, F.regexp_replace(F.trim("line"), "[0-9]+", "0").alias("head")).agg(F.count("*").alias("c")).filter(F.col("c") >= heads).select(book, "head", F.lit(True).alias("running"))
    keyed = lines.withColumn("head", F.when(F.col("n") == 0, F.regexp_replace(F.trim("line"), "[0-9]+", "0")))
    kept = keyed.join(first, [book, "head"], "left").filter(~F.trim("line").rlike("^[0-9]+$") & F.col("running").isNull())
    whole = kept.groupBy(book).agg(F.array_sort(F.collect_list(F.struct(page, "n", "line"))).alias("l"))
    joined = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return whole.select(book, F.regexp_replace(joined, r"(?<=[a-z])-\n(?=[a-z])", "").alias("text"))


def newest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the greatest by the order columns."""
    k = F.row_number().over(W.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in order]))
    return df.withColumn("_k", k).filter("_k = 1").drop("_k")
