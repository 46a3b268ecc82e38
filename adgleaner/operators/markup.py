"""What needs the element tree of a page: microdata items and named blocks.

SQL expressions cannot follow nested elements, so this one step runs in Python
on Arrow batches, and only for pages that hold such markup.
"""

import json
import re
import sys
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Executors need no copy of this package: the helper travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EMPTY_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Attribute that holds the value of an element, by element name.
_VALUE_ATTRIBUTE = {
    "meta": "content",
    "audio": "src", "embed": "src", "iframe": "src", "img": "src",
    "source": "src", "track": "src", "video": "src",
    "a": "href", "area": "href", "link": "href",
    "object": "data", "data": "value", "meter": "value", "time": "datetime",
}
_ADDRESS_ATTRIBUTES = ("src", "href", "data")

# Classes of the two blocks on pages of the auction site.
SELLER_CLASS = "ux-seller-section__item--seller"
LOCATION_CLASS = "ux-labels-values--itemLocation"

TREE_RESULT = T.StructType(
    [
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("seller_block", T.StringType()),
        T.StructField("location_block", T.StringType()),
        T.StructField("bodies", T.ArrayType(T.StringType())),
    ]
)


# Elements that a start tag of another ends, as long as no element of the second list stands between.
_ENDED_BY = {
    **dict.fromkeys(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split(),
        (("p",), ()),
    ),
    "li": (("li", "p"), ("ul", "ol", "menu")),
    "dt": (("dt", "dd", "p"), ("dl",)),
    "dd": (("dt", "dd", "p"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
}
# What keeps an inner element from ending a paragraph outside of it.
_SCOPE = frozenset("button td th caption table object marquee template".split())
# By start tag: what it ends, and what stands in the way.
_ENDS = {tag: (ended, tuple({*within, *_SCOPE.difference(ended)})) for tag, (ended, within) in _ENDED_BY.items()}


class _Open:
    """An open element and what it collects."""

    __slots__ = ("tag", "id", "item", "names", "text", "kind")

    def __init__(self, tag):
        self.tag = tag
        self.id = None
        self.item = self.names = self.text = self.kind = None


class _TreeReader(HTMLParser):
    """Walks a page once, with the open elements on a stack."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base = base
        self.stack = []
        self.items = []
        self.open_items = []
        self.collectors = []
        self.open_kinds = []
        self.seller = None
        self.location = None
        # Where in the stack elements of each name are open.
        self.places = {}
        # For `itemref`: items that name elements, and the properties found below each id outside of items.
        self.referring = []
        self.by_id = {}

    def handle_starttag(self, tag, attrs):
        self._end_implied(tag)
        entry = _Open(tag)
        if attrs:
            attr = {k: v or "" for k, v in reversed(attrs)}
            if "id" in attr and not self.open_items:
                entry.id = attr["id"]
            if "itemscope" in attr or "itemprop" in attr:
                self._microdata(entry, attr)
            if tag == "div" and "class" in attr:
                self._block(entry, attr["class"].split())
        if self.open_kinds and tag in ("a", "span"):
            self._seller_part(entry)
        if tag in _EMPTY_ELEMENTS:
            return
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(entry)
        if entry.item is not None:
            self.open_items.append(entry.item)
        if entry.text is not None:
            self.collectors.append(entry.text)
        if entry.kind:
            self.open_kinds.append(entry.kind)

    def _end_implied(self, tag):
        """Close what a start tag ends without an end tag of its own."""
        if tag not in _ENDS:
            return
        ended, barriers = _ENDS[tag]
        # The innermost of each name is enough, so that no tag looks through the stack.
        while (at := self._innermost(ended)) > self._innermost(barriers):
            while len(self.stack) > at:
                self._leave()

    def _innermost(self, tags) -> int:
        innermost, places = -1, self.places
        for tag in tags:
            if tag in places and (found := places[tag]) and found[-1] > innermost:
                innermost = found[-1]
        return innermost

    def _microdata(self, entry, attr):
        owner = self.open_items[-1] if self.open_items else self._loose(entry)
        names = attr.get("itemprop", "").split()
        if "itemscope" in attr:
            item = entry.item = {}
            if attr.get("itemref"):
                self.referring.append((item, attr["itemref"].split()))
            kind = attr.get("itemtype", "").split()
            if kind:
                item["@context"], _, item["@type"] = kind[0].rpartition("/")
            if not names:
                self.items.append(item)
            elif owner is not None:
                self._add(owner, names, item)
        elif names and owner is not None:
            held = _VALUE_ATTRIBUTE.get(entry.tag)
            if held:
                value = attr.get(held)
                if value is not None and held in _ADDRESS_ATTRIBUTES:
                    value = _absolute(self.base, value)
                self._add(owner, names, value)
            elif attr.get("content"):
                self._add(owner, names, attr["content"])
            else:
                entry.names, entry.text = (owner, names), []

    def _loose(self, entry):
        """Where properties outside of items go that an item may name: one place per outermost id."""
        name = entry.id or next((e.id for e in self.stack if e.id), None)
        return self.by_id.setdefault(name, {}) if name else None

    def resolve_references(self):
        """Give items the properties of the elements that their `itemref` names."""
        for item, names in self.referring:
            for name in names:
                for key, value in self.by_id.get(name, {}).items():
                    for one in value if isinstance(value, list) else [value]:
                        self._add(item, [key], one)

    def _block(self, entry, classes):
        if SELLER_CLASS in classes and self.seller is None:
            entry.kind = "seller"
        elif LOCATION_CLASS in classes and self.location is None:
            entry.kind = "location"
            entry.text = entry.text if entry.text is not None else []

    def _seller_part(self, entry):
        within = self.open_kinds[-1]
        if entry.tag == "a" and within == "seller":
            entry.kind = "seller link"
        elif entry.tag == "span" and within == "seller link" and self.seller is None:
            entry.kind = "seller name"
            entry.text = entry.text if entry.text is not None else []

    def handle_endtag(self, tag):
        # What is open by name tells a stray end tag without a look at the stack.
        if self.places.get(tag):
            while self._leave() != tag:
                pass

    def handle_data(self, data):
        if self.collectors and self.stack[-1].tag not in ("script", "style"):
            for text in self.collectors:
                text.append(data)

    def _leave(self) -> str:
        entry = self.stack.pop()
        self.places[entry.tag].pop()
        if entry.item is not None:
            self.open_items.pop()
        if entry.text is not None:
            self.collectors.pop()
            text = "".join(entry.text)
            if entry.names:
                self._add(*entry.names, " ".join(text.split()))
            if entry.kind == "seller name" and self.seller is None:
                self.seller = text.strip()
            if entry.kind == "location" and self.location is None:
                self.location = text
        if entry.kind:
            self.open_kinds.pop()
        return entry.tag

    def close(self):
        super().close()
        while self.stack:
            self._leave()

    @staticmethod
    def _add(item, names, value):
        """A property named again becomes a list."""
        for name in names:
            if name not in item:
                item[name] = value
            elif isinstance(item[name], list):
                item[name].append(value)
            else:
                item[name] = [item[name], value]


def _absolute(base: str, address: str) -> str:
    """The address against the page's; as it stands if it is no address."""
    try:
        return urljoin(base, address.strip())
    except ValueError:
        return address.strip()


def read_tree(html: str, base: str) -> tuple[list[str], str | None, str | None]:
    """Top-level microdata items as JSON texts, seller name and location block of a page."""
    reader = _TreeReader(base or "")
    try:
        reader.feed(html)
        reader.close()
    except Exception:  # noqa: BLE001  whatever a page holds, it does not end the job: what was found so far counts
        while reader.stack:
            reader._leave()
    reader.resolve_references()
    return [t for t in map(_as_json, reader.items) if t], reader.seller, reader.location


def _as_json(item: dict) -> str | None:
    """None for an item that refers to itself."""
    try:
        return json.dumps(item, ensure_ascii=False)
    except (ValueError, RecursionError):
        return None


def plain_json(body: str) -> str | None:
    """JSON that every reader takes: of a repeated key the last counts, as in browsers; a line break counts as a space."""
    try:
        return json.dumps(json.loads(re.sub(r"[\x00-\x1f]", " ", body)), ensure_ascii=False)
    except (ValueError, RecursionError):
        return None


@F.arrow_udf(TREE_RESULT)
def _read_trees(html: pa.Array, base: pa.Array, bodies: pa.Array) -> pa.Array:
    nothing = ([], None, None)
    rows = [read_tree(h, b) if h is not None else nothing for h, b in zip(html.to_pylist(), base.to_pylist())]
    items, sellers, locations = zip(*rows) if rows else ((), (), ())
    plain = [b and [plain_json(x) for x in b] for b in bodies.to_pylist()]
    texts = pa.list_(pa.string())
    return pa.StructArray.from_arrays(
        [pa.array(items, texts), pa.array(sellers, pa.string()), pa.array(locations, pa.string()), pa.array(plain, texts)],
        ["items", "seller_block", "location_block", "bodies"],
    )


def page_tree(html: Column, url: Column, site: Column, bodies: Column) -> Column:
    """Struct (items, seller_block, location_block, bodies). Other pages never leave the JVM.

    `bodies` are JSON texts that did not parse as they are, or NULL; they come back as plain JSON.
    """
    markup = html.rlike("(?i)itemscope")
    wanted = markup | F.contains(site, F.lit("ebay"))
    return _read_trees(F.when(wanted, html), F.when(wanted, url), bodies)
