"""Web page tables -> links, titles, ordered text blocks and section rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidenza.functions.text import decode_entities, let, strip
from evidenza.functions.urls import resolve_url

# Which tags are text blocks inside which container class, the
# reading order of sections, and the line that closes a section.
CONTAINERS = {
    ".content-section__content": ("p", "li", "h3"),
    ".content-section__left-side": ("h3",),
}
SECTION_ORDER = (
    "Summary", "Targets", "Policies & Actions", "Net Zero Targets", "Assumptions", "Sources",
)
SECTION_SEPARATOR = "\n---\n"

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"


def visible_markup(html: Column) -> Column:
    """Markup without comments, scripts and styles, whose text can look like tags."""
    return F.regexp_replace(html, _HIDDEN, "")


# --- links and titles -------------------------------------------------------


# An ``a`` tag up to its href: other attributes are passed over whole, quotes and all.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_HREF = rf"""(?is)<a(?=[\s/])(?:[\s/]*+(?!href\s*=)[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+)*+[\s/]*+href\s*=\s*({_VALUE})"""


def link_targets(html: Column) -> Column:
    """All ``href`` values of ``a`` elements, quoted either way or not, in page order."""
    found = F.regexp_extract_all(visible_markup(html), F.lit(_HREF), F.lit(1))

    def target(value: Column) -> Column:
        quoted = F.left(value, F.lit(1)).isin('"', "'")
        return decode_entities(F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value))

    return F.transform(found, target)


def page_links(
    pages: DataFrame,
    part: str = "/countries/",
    slashes: int = 3,
    key: Sequence[str] = ("page_id",),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Distinct resolved links per page whose target contains ``part`` and has
    exactly ``slashes`` slashes.

    De-duplication is inside the row, so no shuffle is needed.
    """
    wanted = F.filter(
        link_targets(F.col(html)),
        lambda a: F.contains(a, F.lit(part)) & (F.length(a) - F.length(F.replace(a, F.lit("/"), F.lit(""))) == slashes),
    )
    resolved = F.array_distinct(F.transform(F.array_distinct(wanted), lambda a: resolve_url(F.col(url), a)))
    return pages.select(*key, F.explode(resolved).alias("link"))


# What stands in a tag after its name: quoted values may hold ``>``; a stray quote ends at the next one.
_ATTRIBUTES = r"""(?=[\s/>])(?:(?:[^"'>]|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""


def _direct_texts(html: Column, tag: str) -> Column:
    """Text pieces that stand directly in each ``tag`` element, in page order.

    An element that is never closed ends with the page.
    """
    inner = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}{_ATTRIBUTES}(.*?)(?:</{tag}\s*+>|\z)"), F.lit(1))
    pieces = F.transform(
        inner,
        lambda s: F.split(
            F.regexp_replace(s, rf"(?is)<([a-z0-9]+){_ATTRIBUTES}.*?</\1\s*>|<[^>]+>", "\x01"), "\x01"
        ),
    )
    return F.filter(F.flatten(pieces), lambda s: s != "")


def page_name(html: Column) -> Column:
    """First ``h1`` text, else the ``title`` text before `` | ``."""

    def name(markup: Column) -> Column:
        h1 = F.try_element_at(_direct_texts(markup, "h1"), F.lit(1))
        title = F.try_element_at(_direct_texts(markup, "title"), F.lit(1))
        return F.coalesce(h1, strip(F.split_part(title, F.lit(" | "), F.lit(1))))

    return decode_entities(let(visible_markup(html), name))


# Elements that never have an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _NavReader(HTMLParser):
    """Links inside the navigations of a page: every element of the wanted tag and classes."""

    def __init__(self, tag: str | None, classes: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.tag, self.classes = tag, classes
        self.nav: str | None = None
        self.depth = 0
        self.links: list[dict] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if self.nav is None:
            wanted = self.tag in (None, tag) and self.classes <= set((values.get("class") or "").split())
            if wanted and tag not in VOID:
                self.nav, self.depth = tag, 1
            return
        self.depth += tag == self.nav
        if tag == "a":
            self.inside = values.get("href") is not None
            if self.inside:
                self.links.append({"href": values["href"], "title": ""})

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False
        if tag == self.nav:
            self.depth -= 1
            if not self.depth:
                self.nav, self.inside = None, False

    def handle_data(self, data):
        if self.inside:
            self.links[-1]["title"] += data


def navigation_links(html: Column, tag: str | None, classes: Sequence[str]) -> Column:
    """``array<struct<href, title>>`` of all navigations of a page, in page order."""
    wanted = frozenset(classes)
    kind = pa.list_(pa.struct([("href", pa.string()), ("title", pa.string())]))

    def read(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in pages:
            found = []
            for page in batch:
                reader = _NavReader(tag, wanted)
                if page.is_valid:
                    reader.feed(page.as_py())
                    reader.close()
                found.append(reader.links)
            yield pa.array(found, kind)

    read.__annotations__ = {"pages": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(read, "array<struct<href: string, title: string>>")(html)


def section_links(
    pages: DataFrame,
    nav_tag: str | None = None,
    nav_classes: Sequence[str] = ("nav", "nav-pills"),
    order: Sequence[str] = SECTION_ORDER,
    skip: Sequence[str] = ("Summary",),
    key: Sequence[str] = ("page_id",),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Section links of the page navigations, in reading order.

    A navigation is an element with all of ``nav_classes``, in any order, and of
    ``nav_tag`` if that is given; it ends with its own end tag, however deep its
    lists are.  Titles rank by their place in ``order`` (case-sensitive), unknown
    titles follow in page order.  ``rank`` is the place within the page; ranking
    is done inside the row.
    """
    found = pages.select(*key, url, navigation_links(F.col(html), nav_tag, nav_classes).alias("_links"))
    known = F.array(*[F.lit(t) for t in order])

    def entry(link: Column, position: Column) -> Column:
        place = F.array_position(known, strip(link["title"]))
        return F.struct(
            F.when(place > 0, place).otherwise(len(order) + 1).cast("int").alias("place"),
            position.cast("int").alias("position"),
            strip(link["title"]).alias("section_title"),
            resolve_url(F.col(url), link["href"]).alias("section_url"),
        )

    kept = F.filter(F.array_sort(F.transform("_links", entry)), lambda e: ~e["section_title"].isin(*skip))
    return found.select(*key, F.posexplode(kept).alias("rank", "e")).select(
        *key, "rank", "e.section_title", "e.section_url"
    )


# --- text blocks ------------------------------------------------------------


class _BlockReader(HTMLParser):
    """Collects the text of block elements that stand inside a container."""

    void = frozenset(
        "area base br col embed hr img input link meta source track wbr".split()
    )
    ends_paragraph = frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header "
        "hr main nav ol p pre section table ul".split()
    )
    bold = frozenset(("b", "strong"))

    def __init__(self, containers: Mapping[str, Sequence[str]]):
        super().__init__(convert_charrefs=True)
        self.containers = containers
        self.open: list[tuple[str, frozenset, dict | None]] = []
        self.open_tags: Counter[str] = Counter()
        self.open_blocks: list[dict] = []
        self.blocks: list[dict] = []
        self.bold_depth = 0
        self.silent = 0

    def _write(self, text: str) -> None:
        for block in self.open_blocks:
            block["parts"].append(text)

    def _close(self, index: int) -> None:
        while len(self.open) > index:
            tag, _, block = self.open[-1]
            if tag in self.bold:
                self.bold_depth -= 1
                if self.bold_depth == 0:
                    self._write("**")
            self.open.pop()
            self.open_tags[tag] -= 1
            if block is not None:
                self.open_blocks.pop()

    def _last(self, tag: str, barriers: Sequence[str] = ()) -> int | None:
        """Place of the innermost open ``tag`` that no barrier hides."""
        if not self.open_tags[tag]:
            return None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                return i
            if self.open[i][0] in barriers:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.silent += 1
        if tag in self.ends_paragraph:
            found = self._last("p", ("td", "th", "button"))
            if found is not None:
                self._close(found)
        if tag == "li":
            found = self._last("li", ("ul", "ol"))
            if found is not None:
                self._close(found)
        if tag in self.void:
            return
        attributes = dict(attrs)
        wanted = self.open[-1][1] if self.open else frozenset()
        block = None
        if tag in wanted:
            block = {"tag": tag, "has_id": bool(attributes.get("id")), "parts": []}
            self.blocks.append(block)
            self.open_blocks.append(block)
        names = [tag] + ["." + c for c in (attributes.get("class") or "").split()]
        inside = wanted.union(*(self.containers.get(n, ()) for n in names))
        if tag in self.bold:
            if self.bold_depth == 0:
                self._write("**")
            self.bold_depth += 1
        self.open.append((tag, inside, block))
        self.open_tags[tag] += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.silent:
            self.silent -= 1
        found = self._last(tag)
        if found is not None:
            self._close(found)

    def handle_data(self, data):
        if not self.silent:
            self._write(data)

    def finish(self) -> list[dict]:
        self.close()
        self._close(0)
        return self.blocks


# Pages whose blocks are held at a time.
PAGES_AT_ONCE = 200


def page_blocks(
    pages: DataFrame,
    containers: Mapping[str, Sequence[str]] = CONTAINERS,
    key: str = "page_id",
    html: str = "html",
) -> DataFrame:
    """Ordered non-empty text blocks ``(key, pos, tag, has_id, text)``.

    ``containers`` maps ``.class`` or ``tag`` to the block tags read inside it.
    Bold text is wrapped in ``**``.  Needs real HTML tree rules (implied end
    tags, nesting), so it is the one page operator that parses in Python.
    """

    key_type = pages.schema[key].dataType.simpleString()
    names = [key, "pos", "tag", "has_id", "text"]
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                rows = []
                for page, markup in enumerate(part.column(html)):
                    reader = _BlockReader(containers)
                    reader.feed(markup.as_py() or "")
                    texts = ((b, "".join(b["parts"]).strip()) for b in reader.finish())
                    kept = [(b, t) for b, t in texts if t]
                    rows += [(page, i, b["tag"], b["has_id"], t) for i, (b, t) in enumerate(kept)]
                page, *others = zip(*rows, strict=True) if rows else [[]] * 5
                keys = part.column(key).take(pa.array(page, pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(others, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([keys, *columns], names)

    return pages.select(key, html).mapInArrow(
        read, f"`{key}` {key_type}, pos int, tag string, has_id boolean, text string"
    )


def block_markdown(tag: Column, has_id: Column, text: Column) -> Column:
    """Markdown line of one block."""
    return (
        F.when((tag == "h3") & has_id, F.concat(F.lit("\n## "), text, F.lit("\n")))
        .when(tag == "h3", F.concat(F.lit("\n### "), text, F.lit("\n")))
        .when(tag == "li", F.concat(F.lit("- "), text))
        .otherwise(F.concat(text, F.lit("\n")))
    )


# --- assembling sections ----------------------------------------------------


def latest_sections(
    sections: DataFrame, order: Sequence[str], key: Sequence[str] = ("country", "section_title")
) -> DataFrame:
    """One row per (country, title): a later write of the same title wins.

    Spark keeps only the best row of each key inside every map task before the
    shuffle, so a title written very many times does not meet in one task.
    """
    window = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return sections.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def document_lines(
    sections: DataFrame,
    key: Sequence[str] = ("country", "section_no"),
    title: str = "section_title",
    content: str = "content",
) -> DataFrame:
    """Flattened document as ordered lines: ``# title``, paragraphs, separator.

    The document stays a set of rows ordered by ``(*key, line_no)``; even a
    country that holds most of the data is never gathered into one value.
    """
    lines = F.concat(
        F.array(F.concat(F.lit("# "), F.col(title))),
        F.coalesce(F.col(content), F.array().cast("array<string>")),
        F.array(F.lit(SECTION_SEPARATOR)),
    )
    return sections.select(*key, F.posexplode(lines).alias("line_no", "line"))


def markdown_lines(
    sections: DataFrame,
    key: Sequence[str] = ("country", "section_no"),
    title: str = "section_title",
    content: str = "content",
) -> DataFrame:
    """Markdown page lines of each section: a ``# title`` heading, then its blocks."""
    lines = F.concat(
        F.array(F.concat(F.lit("\n# "), F.col(title), F.lit("\n"))),
        F.coalesce(F.col(content), F.array().cast("array<string>")),
    )
    return sections.select(*key, F.posexplode(lines).alias("line_no", "line"))
