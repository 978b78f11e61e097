"""Markdown from HTML: the text is cut into tokens once, and one fold over them carries lists, links and emphasis.

A small helper for one text at a time; ``html_to_markdown`` runs it over Arrow batches.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|head|template)(?=[\s/>])[^<>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>"
    r"|<[!?/][^<>]*>"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"[ \t\r\n\f]+")

_BLOCKS = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form header html main nav ol p pre "
    "section summary table tbody tfoot thead tr ul".split()
)
_MARKS = {"b": "**", "strong": "**", "i": "_", "em": "_", "code": "`", "tt": "`", "s": "~~", "del": "~~"}
_BREAK = "\x01"
_BLANK = _BREAK + " \t\r\n\f\xa0"


class _Writer:
    """Blocks that are done, and the inline parts, lists, links and marks of the one at work."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, bool]] = []  # text, and whether it is a list's item or goes on with a table
        self.parts: list[str] = []
        self.prefix = ""
        self.lists: list[list] = []  # kind and number of the last item
        self.links: list[tuple[str, int]] = []
        self.marks: list[tuple[str, int]] = []  # open ones, and which part each is
        self.quotes = self.verbatim = 0
        self.tight = False

    def flush(self) -> None:
        """End a block. Marks and links that are open end with it."""
        if self.verbatim:
            lines = "".join(self.parts).strip("\n").split("\n")
            text = "\n".join("    " + line for line in lines) if any(lines) else ""
        else:
            while self.links:
                self.end_link()
            opened = {place for _, place in self.marks}
            while self.parts and (len(self.parts) - 1 in opened or not self.parts[-1].strip(_BLANK)):
                self.parts.pop()  # behind a mark without text, too
            closing = "".join(mark for mark, place in reversed(self.marks) if place < len(self.parts))
            text = _SPACE.sub(" ", "".join(self.parts)).replace("\xa0", " ")
            text = re.sub(rf" ?{_BREAK} ?", _BREAK, text).strip(f" {_BREAK}") + closing
            text = text.replace(_BREAK, "  \n")
        if text:
            whole = self.prefix + text
            self.blocks.append(("\n".join("> " * self.quotes + line for line in whole.split("\n")), self.tight))
        self.parts, self.marks, self.prefix, self.tight = [], [], "", False

    def start(self, tag: str, rest: str) -> None:
        if tag in _MARKS:
            if not self.verbatim:
                self.marks.append((_MARKS[tag], len(self.parts)))
                self.parts.append(_MARKS[tag])
        elif tag == "a":
            self.end_link()
            href = _attributes(rest).get("href")
            if href:
                self.links.append((href, len(self.parts)))
                self.parts.append("[")
        elif tag == "br":
            self.parts.append("\n" if self.verbatim else _BREAK)
        elif tag == "img":
            found = _attributes(rest)
            if found.get("src"):
                self.parts.append(f"![{found.get('alt', '')}]({found['src']})")
        elif tag == "hr":
            self.flush()
            self.parts.append("* * *")
            self.flush()
        elif tag in ("td", "th"):
            if any(part.strip() for part in self.parts):
                self.parts.append(" | ")
        elif tag == "li":
            self.flush()
            depth = max(1, len(self.lists))
            sign = "*"
            if self.lists:
                self.lists[-1][1] += 1
                sign = f"{self.lists[-1][1]}." if self.lists[-1][0] == "ol" else "*"
            self.prefix, self.tight = "  " * depth + sign + " ", True
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.flush()
            self.prefix = "#" * int(tag[1]) + " "
        elif tag in _BLOCKS:
            keeps = tag in ("p", "div") and self.prefix and not any(part.strip() for part in self.parts)
            if not keeps:  # the first paragraph of an item or heading is its text
                self.flush()
            if tag in ("ul", "ol"):
                self.lists.append([tag, 0])
            elif tag == "blockquote":
                self.quotes += 1
            elif tag == "pre":
                self.verbatim += 1
            elif tag == "tr":
                self.tight = True

    def end(self, tag: str) -> None:
        if tag in _MARKS:
            while any(mark == _MARKS[tag] for mark, _ in self.marks):  # marks within it end with it
                mark, place = self.marks.pop()
                if place == len(self.parts) - 1:
                    self.parts.pop()
                else:
                    self.parts.append(mark)
                if mark == _MARKS[tag]:
                    break
        elif tag == "a":
            self.end_link()
        elif tag == "br":
            self.start(tag, "")
        elif tag in ("li", "dd", "dt") or tag in _BLOCKS or (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"):
            self.flush()
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag == "blockquote" and self.quotes:
                self.quotes -= 1
            elif tag == "pre" and self.verbatim:
                self.verbatim -= 1

    def end_link(self) -> None:
        if self.links:
            href, place = self.links.pop()
            if any(part.strip() for part in self.parts[place + 1 :]):
                while self.marks and self.marks[-1][1] > place:  # marks in a link end with it
                    self.parts.append(self.marks.pop()[0])
                self.parts.append(f"]({href})")
            else:
                del self.parts[place:]
                self.marks = [mark for mark in self.marks if mark[1] < place]

    def whole(self) -> str:
        self.flush()
        out = []
        for number, (text, tight) in enumerate(self.blocks):
            if number:
                out.append("\n" if tight and self.blocks[number - 1][1] else "\n\n")
            out.append(text)
        return "".join(out)


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape("".join(values)).strip())
    return found


def markdown_of(text: str | None) -> str:
    """Markdown of an HTML fragment.

    Headings, emphasis, links, images, nested and numbered lists, quotations, preformatted text, rules, line breaks and
    the rows of tables are kept; scripts, styles, the head, comments and all other tags go. Character references are
    decoded, white space counts as one space. Marks left open end with their block. Null is an empty text.
    """
    if not text:
        return ""
    writer = _Writer()
    for token in _TOKEN.finditer(text.replace(_BREAK, " ")):
        kind = token.lastgroup
        if kind == "text":
            writer.parts.append(html.unescape(token["text"]))
        elif token["tag"]:
            tag = token["tag"].lower()
            writer.end(tag) if token["end"] else writer.start(tag, token["rest"])
    return writer.whole()


@F.pandas_udf(T.StringType())
def _markdown(texts: pd.Series) -> pd.Series:
    return texts.map(markdown_of, na_action=None)


def html_to_markdown(text: Column) -> Column:
    """Markdown text of an HTML fragment; empty text for null."""
    return _markdown(F.coalesce(text.cast("string"), F.lit("")))
