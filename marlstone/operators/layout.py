"""Layout HTML to region rows: the one step that needs a parser."""

from __future__ import annotations

from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style"))


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]]):
        self.tag, self.attrs, self.children = tag, dict(attrs), []

    def walk(self) -> Iterator[Node]:
        """All nodes below, in document order."""
        todo = list(reversed(self.children))
        while todo:
            node = todo.pop()
            if isinstance(node, Node):
                yield node
                todo += reversed(node.children)

    def find(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def text(self) -> str:
        """Text nodes joined by a space, then stripped."""
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            elif node is self or node.tag not in SILENT:
                todo += reversed(node.children)
        return " ".join(out).strip()

    def html(self) -> str:
        attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in self.attrs.items())
        if self.tag in VOID:
            return f"<{self.tag}{attrs}/>"
        inner = "".join(c.html() if isinstance(c, Node) else escape(c, quote=False) for c in self.children)
        return f"<{self.tag}{attrs}>{inner}</{self.tag}>"


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", [])
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].children.append(Node(tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def regions(html: str) -> list[dict]:
    """Every div with both data-bbox and data-label, in document order."""
    out = []
    for div in parse(html).walk():
        if div.tag != "div" or "data-bbox" not in div.attrs or "data-label" not in div.attrs:
            continue
        table, image, items = div.find("table"), div.find("img"), div.find("ul") or div.find("ol")
        out.append({
            "ord": len(out),
            "label": (div.attrs["data-label"] or "").strip(),
            "bbox": (div.attrs["data-bbox"] or "").strip(),
            "text": div.text(),
            "table_html": table.html() if table else None,
            "has_image": image is not None,
            "alt": (image.attrs.get("alt") or "").strip() if image else None,
            "items": [n.text() for n in items.walk() if n.tag == "li"] if items else None,
        })
    return out


_FIELDS = {"ord": (pa.int32(), T.IntegerType()), **dict.fromkeys(("label", "bbox", "text", "table_html"), (pa.string(), T.StringType())), "has_image": (pa.bool_(), T.BooleanType()), "alt": (pa.string(), T.StringType()), "items": (pa.list_(pa.string()), T.ArrayType(T.StringType()))}
_REGION = pa.list_(pa.struct([(n, t) for n, (t, _) in _FIELDS.items()]))
REGIONS = T.ArrayType(T.StructType([T.StructField(n, t) for n, (_, t) in _FIELDS.items()]))


@F.arrow_udf(REGIONS)
def _regions(html: pa.Array) -> pa.Array:
    return pa.array([regions(h or "") for h in html.to_pylist()], _REGION)


def with_regions(df: DataFrame, html: str = "html") -> DataFrame:
    """df with an array column ``regions``; null html has none.  Only the html goes to Python."""
    return df.withColumn("regions", _regions(F.col(html)))


def exploded(df: DataFrame) -> DataFrame:
    """One row a region."""
    return df.withColumn("region", F.explode("regions")).drop("regions")
