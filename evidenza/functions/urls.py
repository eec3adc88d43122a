"""URL handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without_dots(path: Column) -> Column:
    """Fold ``.`` and ``..`` segments of an absolute path."""

    def step(done: Column, segment: Column) -> Column:
        parent = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return (
            F.when(segment == "..", parent)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(path, "/")
    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    # a path that ends in a dot segment names a directory
    closed = F.when(path.rlike(r"/\.{1,2}$"), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.array_join(closed, "/")).otherwise(path)


def resolve_url(base: Column, link: Column) -> Column:
    """Resolve ``link`` against the page it stands on, as a browser would."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.substr(link, F.length(path) + 1)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("#"), F.concat(no_fragment, link))
        .when(link.startswith("?"), F.concat(no_query, link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(path), rest))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), rest))
    )


def slug_after(url: Column, marker: str) -> Column:
    """Text after the last ``marker`` (whole URL if absent), slashes stripped."""
    return F.btrim(F.split_part(url, F.lit(marker), F.lit(-1)), F.lit("/"))
