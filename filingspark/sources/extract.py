"""Text of files: HTML, plain text, DOCX, XLSX and ZIP archives, with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXT_SUFFIXES = (".txt", ".csv", ".json", ".xml")
#: Limits of an archive: members, supported members, bytes of one and of all, and how far it may unpack.
MEMBERS, SUPPORTED, ONE, ALL, RATIO = 100, 50, 50 << 20, 100 << 20, 200
CELLS = 250_000


def normalise(text: str) -> str:
    text = re.sub(r"[ \t]+", " ", text.replace("\x00", ""))
    return re.sub(r"\n{4,}", "\n\n\n", text).strip()


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: object) -> None:
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(data)


#: Stands for an ampersand that begins no reference: a lone surrogate, which no decoded text holds.
PLAIN = "\ud800"


def _closed(m: re.Match) -> str:
    return m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else PLAIN + (m[1] or "")


def html_text(source: str, closed: bool = False) -> str:
    """Text nodes joined by line ends; scripts, styles and comments left out.

    As in browsers an old name such as &amp is a reference without its semicolon, too; with `closed`, only whole names
    with their semicolon are, and all else stays as written.
    """
    parser = _Text()
    parser.feed(re.sub(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?", _closed, source) if closed else source)
    parser.close()
    return normalise("\n".join(parser.out).replace(PLAIN, "&"))


def docx_text(data: bytes) -> str:
    """Paragraphs that aren't blank, then tables with tabs between cells."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    words = lambda e: "".join(t.text or "" for t in e.iter(f"{w}t"))
    lines = [t for p in body.findall(f"{w}p") if (t := words(p)).strip()]
    lines += ["\t".join(words(c) for c in row.findall(f"{w}tc")) for table in body.findall(f"{w}tbl") for row in table.findall(f"{w}tr")]
    return normalise("\n".join(lines))


#: Terms by which sheets are told apart, in titles first and then in what a sheet begins with, and the names of the four ranks.
TAXONOMY_TERMS = ("inlinexbrl", "inline xbrl", "token", "hidden", "taxonomy", "schema", "xbrl", "contexts", "units")
PRIMARY_TERMS = (
    "statement of financial position", "financial position", "balance sheet", "posisi keuangan",
    "income statement", "profit or loss", "profit and loss", "laba rugi", "pendapatan",
    "cash flow", "arus kas", "changes in equity", "perubahan ekuitas",
    "statement of comprehensive income", "penghasilan komprehensif",
)
SUPPORTING_TERMS = ("notes", "catatan", "segment", "segmen", "context")
RANKS = ("PRIMARY", "GENERAL", "SUPPORTING", "TAXONOMY")
#: Rows and values at the beginning of a sheet that its rank may rest on.
SAMPLE_ROWS, SAMPLE_VALUES = 25, 80


def _rank(text: str, order: tuple[tuple[int, tuple[str, ...]], ...]) -> int | None:
    return next((rank for rank, terms in order if any(t in text for t in terms)), None)


def sheet_priority(title: str, sample: list[str]) -> int:
    """0 for statements, 1 for all else, 2 for notes and segments, 3 for taxonomy sheets: by the title, or by the first values if that tells nothing."""
    by_title = _rank(title.strip().lower(), ((3, TAXONOMY_TERMS), (0, PRIMARY_TERMS), (2, SUPPORTING_TERMS)))
    if by_title is not None:
        return by_title
    by_values = _rank(" | ".join(sample), ((0, PRIMARY_TERMS), (3, TAXONOMY_TERMS), (2, SUPPORTING_TERMS)))
    return 1 if by_values is None else by_values


def _cell(c: ElementTree.Element, m: str, shared: list[str]) -> str:
    """A cell's stored value as text; a formula without one is shown as such."""
    v, f, kind = c.find(f"{m}v"), c.find(f"{m}f"), c.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{m}t"))
    if v is None or v.text is None:
        return f"[FORMULA_NO_CACHED_VALUE {c.get('r')}: ={f.text}]" if f is not None and f.text else ""
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return str(v.text == "1")
    if kind in (None, "n") and re.fullmatch(r"[+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?", v.text):
        return str(float(v.text)) if re.search("[.eE]", v.text) else str(int(v.text))
    return v.text


def _rows(root: ElementTree.Element, m: str, shared: list[str]) -> list[tuple[int, list[str]]]:
    """(number, cells without blank ones at the end) of the rows that aren't blank."""
    out, number = [], 0
    for row in root.iter(f"{m}row"):
        number = int(row.get("r") or number + 1)
        cells: list[str] = []
        for c in row.findall(f"{m}c"):
            column = 0
            for ch in re.match(r"[A-Z]*", c.get("r") or "")[0]:
                column = column * 26 + ord(ch) - 64
            cells += [""] * (column - 1 - len(cells))
            cells.append(_cell(c, m, shared))
        while cells and not cells[-1].strip():
            cells.pop()
        if cells:
            out.append((number, cells))
    return out


def xlsx_text(data: bytes, cap: int = CELLS) -> str:
    """Sheets by rank and title; rows as ROW n | cell | cell, up to a cap on cells over all sheets."""
    m = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in s.iter(f"{m}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{m}si")]
        paths = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = []
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{m}sheet"):
            rows = _rows(ElementTree.fromstring(z.read("xl/" + paths[s.get(rel)].lstrip("/").removeprefix("xl/"))), m, shared)
            first = [c.strip().lower() for n, cells in rows if n <= SAMPLE_ROWS for c in cells if c.strip()][:SAMPLE_VALUES]
            sheets.append((sheet_priority(s.get("name"), first), s.get("name").strip().lower(), s.get("name"), rows))
    out, used = [], 0
    for rank, _, name, rows in sorted(sheets, key=lambda s: s[:2]):
        out.append(f"\n\n===== SHEET: {name} =====\nSHEET PRIORITY: {RANKS[rank]}")
        for number, cells in rows:
            used += len(cells)
            if used > cap:
                return normalise("\n".join([*out, "\n[TRUNCATED: spreadsheet cell limit reached after priority ordering]"]))
            out.append(" | ".join([f"ROW {number}", *cells]))
    return normalise("\n".join(out))


def zip_members(data: bytes) -> list[tuple[str, bytes]]:
    """The supported members of an archive; unsafe archives are an error."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        infos = [i for i in z.infolist() if not i.is_dir()]
        if len(infos) > MEMBERS:
            raise ValueError("too many members")
        for i in infos:
            if i.filename.startswith(("/", "\\")) or ".." in re.split(r"[/\\]", i.filename) or (i.external_attr >> 16) & 0o170000 == 0o120000 or i.flag_bits & 1:
                raise ValueError(f"unsafe member {i.filename}")
            if i.file_size > ONE or i.file_size > RATIO * max(1, i.compress_size):
                raise ValueError(f"member {i.filename} is too large")
        if sum(i.file_size for i in infos) > ALL:
            raise ValueError("the archive is too large")
        good = [i for i in infos if suffix(i.filename) in (*TEXT_SUFFIXES, ".html", ".htm", ".docx", ".xlsx", ".xlsm")]
        if not good:
            raise ValueError("no supported member")
        if len(good) > SUPPORTED:
            raise ValueError("too many supported members")
        return [(i.filename, z.read(i)) for i in good]


def suffix(name: str) -> str:
    m = re.search(r"[^./](\.[^./]+)$", name)
    return m[1].lower() if m else ""


def extract(name: str, content_type: str, data: bytes, closed: bool = False) -> tuple[str, str]:
    """(text, method) of a file by suffix or content type; an unknown kind is an error. `closed` as in html_text()."""
    end, kind = suffix(name), (content_type or "").lower()
    if end in (".html", ".htm") or "html" in kind:
        return html_text(data.decode("utf-8", "replace"), closed), "html"
    if end == ".docx" or "wordprocessingml" in kind:
        return docx_text(data), "docx"
    if end in (".xlsx", ".xlsm") or "spreadsheetml" in kind:
        return xlsx_text(data), "xlsx"
    if end == ".zip" or "zip" in kind:
        found, failed = [], []
        for member, content in zip_members(data):
            try:
                found.append((member, *extract(member, "", content, closed)))
            except Exception as e:
                failed.append(f"[FAILED {member}: {e}]")
        methods = "+".join(dict.fromkeys(m for _, _, m in found))
        return normalise("\n".join([f"===== FILE: {n} =====\n{t}" for n, t, _ in found] + failed)), f"zip[{methods}]"
    if end in TEXT_SUFFIXES or kind.startswith("text/"):
        return normalise(data.decode("utf-8", "replace")), "text"
    raise ValueError(f"unsupported file type {end or kind}")


def extract_files(files: DataFrame, closed: bool = False) -> DataFrame:
    """files (path, content_type, content) with text, method and error of each; `closed` as in html_text()."""

    @F.arrow_udf("struct<text:string,method:string,error:string>")
    def run(paths: pa.Array, kinds: pa.Array, contents: pa.Array) -> pa.Array:
        out = []
        for p, k, c in zip(paths.to_pylist(), kinds.to_pylist(), contents.to_pylist(), strict=True):
            try:
                out.append((*extract(p or "", k or "", c or b"", closed), None))
            except Exception as e:
                out.append((None, None, str(e)[:300]))
        return pa.StructArray.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(3)], ["text", "method", "error"])

    rows = files.withColumn("_x", run("path", "content_type", "content"))
    return rows.select("path", "content_type", "_x.*")


def html_pages(pages: DataFrame, closed: bool = False) -> DataFrame:
    """pages (page_id, html) as page_id, text; `closed` as in html_text()."""

    @F.arrow_udf("string")
    def run(arr: pa.Array) -> pa.Array:
        return pa.array([None if h is None else html_text(h, closed) for h in arr.to_pylist()], pa.string())

    return pages.select("page_id", run("html").alias("text"))
