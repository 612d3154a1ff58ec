"""Plain text from HTML: a native expression for pages, a small parser for elements."""

from __future__ import annotations

import json
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import UNICODE_SPACE

# Parts pieces of one page; Unicode keeps it free of meaning.
PIECE_END = "\ufdd0"

# Elements that never hold content.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text is shown only when asked for directly.
OPAQUE_ELEMENTS = frozenset("script style template rt rp".split())
# Elements that keep white space as written.
PREFORMATTED = frozenset(["pre", "textarea"])


# What may follow "&": a decimal or hexadecimal number, or a name.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that need no semicolon, the longest of several that fit first.
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Numbers that stand for the characters of code page 1252.
_REMAPPED = {0x0: "\ufffd", 0xD: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map; as JSON text, which is folded into one literal, it costs no expression for each entry."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numbered(code: Column) -> Column:
    """The character of a code point (as a long)."""
    gone = code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    real = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.isNull() | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when((code <= 0xD) | code.between(0x80, 0x9F), F.coalesce(F.try_element_at(_literal_map({str(n): c for n, c in _REMAPPED.items()}), code.cast("string")), F.when(gone, "").otherwise(real)))
        .when(gone, "")
        .otherwise(real)
    )


def _decoded_piece(piece: Column) -> Column:
    """What stands behind an "&", with the reference it may begin with decoded."""
    found = F.regexp_extract(piece, _REFERENCE, 1)
    rest = F.substring(piece, F.length(found) + 1, F.length(piece))
    digits = F.regexp_extract(found, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    base = F.when(found.rlike("^#[xX]"), 16).otherwise(10)
    # More than seven digits are beyond all code points.
    code = F.when(F.length(digits) <= 7, F.coalesce(F.conv(F.when(base == 16, digits), 16, 10), F.conv(F.when(digits == "", "0").otherwise(digits), 10, 10)).cast("long"))
    named = F.try_element_at(_literal_map(html5), found)
    bare = F.regexp_extract(found, f"^({'|'.join(_BARE_NAMES)})", 1)
    by_prefix = F.concat(F.try_element_at(_literal_map({n: html5[n] for n in _BARE_NAMES}), bare), F.substring(piece, F.length(bare) + 1, F.length(piece)))
    return (
        F.when(found == "", F.concat(F.lit("&"), piece))
        .when(found == "amp;", F.concat(F.lit("&"), rest))
        .when(found == "lt;", F.concat(F.lit("<"), rest))
        .when(found == "gt;", F.concat(F.lit(">"), rest))
        .when(found.startswith("#"), F.concat(_numbered(code), rest))
        .otherwise(F.coalesce(F.concat(named, rest), by_prefix, F.concat(F.lit("&"), piece)))
    )


def decode_references(text: Column) -> Column:
    """All named and numeric character references, as browsers read them: names without a semicolon and prefixes of names too."""
    pieces = F.split(text, "&")
    later = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), _decoded_piece)
    return F.when(text.rlike("&[#0-9A-Za-z]"), F.concat(F.get(pieces, F.lit(0)), F.array_join(later, ""))).otherwise(text)


def _without_markup(html: Column) -> Column:
    """Scripts, styles, comments and tags become blanks."""
    text = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    return F.regexp_replace(text, r"<[^>]*>", " ")


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{UNICODE_SPACE}]+", " "))


def strip_markup(html: Column) -> Column:
    """Scripts, styles, comments and tags out; character references decoded; white space collapsed."""
    return _collapsed(decode_references(_without_markup(html)))


def block_texts(html: Column, tag: str = "p") -> Column:
    """Text of each piece that an opening ``tag`` starts; the part before the first is dropped."""
    body = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    pieces = F.split(body, rf"(?i)<{tag}(?:\s[^>]*)?>")
    kept = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), _without_markup)
    # References are decoded once for all pieces; the separator is no white space and no character of text.
    joined = decode_references(F.array_join(kept, PIECE_END))
    return F.when(F.size(kept) == 0, kept).otherwise(F.transform(F.split(joined, PIECE_END), _collapsed))


class _Element:
    __slots__ = ("name", "element_id", "order", "direct", "text")

    def __init__(self, name, element_id, order):
        self.name = name
        self.element_id = element_id
        self.order = order
        self.direct = []  # texts of direct children, stripped
        self.text = []  # everything shown inside the element


class ElementReader(HTMLParser):
    """Collects ``(order, tag, id, direct_text, full_text)`` for elements that have an id.

    One pass with a list of open elements. A closing tag closes the nearest
    open element of that name and all inside it; closing tags without one are
    ignored. ``direct_text`` joins the children by line, leaving out nested
    elements called ``section_tag``; ``full_text`` is all shown text.
    """

    def __init__(self, section_tag):
        super().__init__(convert_charrefs=True)
        self.section_tag = section_tag
        self.found = []
        self.page = _Element("", None, 0)
        self.open = [self.page]
        self.started = 0
        self.pending = []

    def flush_text(self):
        if not self.pending:
            return
        string = "".join(self.pending)
        self.pending = []
        if not string.strip("\n\t\x0c\r ") and not any(e.name in PREFORMATTED for e in self.open):
            string = "\n" if "\n" in string else " "
        self.open[-1].text.append(string)
        if string.strip():
            self.open[-1].direct.append(string.strip())

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self.flush_text()
        if data.strip():
            self.open[-1].direct.append(data.strip())

    def handle_decl(self, decl):
        self.flush_text()

    def handle_pi(self, data):
        self.flush_text()

    def unknown_decl(self, data):
        self.flush_text()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA[") :])
            self.flush_text()

    def handle_starttag(self, tag, attrs):
        self.flush_text()
        self.started += 1
        self.open.append(_Element(tag, dict(attrs).get("id"), self.started))
        if tag in VOID_ELEMENTS:
            self.close_innermost()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush_text()
        if not any(e.name == tag for e in self.open[1:]):
            return
        while self.open[-1].name != tag:
            self.close_innermost()
        self.close_innermost()

    def close_innermost(self):
        element = self.open.pop()
        parent = self.open[-1]
        full = "".join(element.text)
        if element.name not in OPAQUE_ELEMENTS:
            parent.text.append(full)
        if element.name != self.section_tag:
            parent.direct.append(full.strip())
        if element.element_id:
            direct = "\n".join(element.direct)
            self.found.append((element.order, element.name, element.element_id, direct, full))

    def finish(self):
        self.close()
        self.flush_text()
        while len(self.open) > 1:
            self.close_innermost()
        return sorted(self.found), "".join(self.page.text)


def read_elements(html: str, section_tag: str = "section"):
    """Elements with an id, in document order, and the page's whole text."""
    reader = ElementReader(section_tag)
    reader.feed(html)
    return reader.finish()
