"""Column functions over filesystem URIs.

Every URI column holds one spelling, ``scheme://authority/path``, with the path
decoded and without a trailing slash (``file:///data/a b``). Roots are passed as
plain strings in the same spelling.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE = "file"
DIRECTORY = "directory"

# Full-match patterns for the marker files that writers leave behind.
EXCLUDE_PATTERNS = (
    r".*/_temporary($|/.*)",
    r".*/_committed.*",
    r".*/_started.*",
    r".*/_SUCCESS.*",
)

# Scheme, authority and path of a URI; the first two may be missing.
URI_PATTERN = r"(?s)^(?:([^/:]+):)?(?://(?=.)([^/]*))?(.*)$"
_NEEDS_NORMALISING = r"//|(^|/)\.{1,2}(/|$)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _after(text: Column, characters: Column | int) -> Column:
    """The text behind its first ``characters`` characters."""
    start = F.lit(characters + 1) if isinstance(characters, int) else characters + 1
    return F.substr(text, start)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(uri: Column) -> tuple[Column, Column, Column]:
    """Scheme, authority and path; '' where one is missing."""
    return tuple(F.regexp_extract(uri, URI_PATTERN, group) for group in (1, 2, 3))


def _normal_path(path: Column) -> Column:
    """An absolute path without empty, ``.`` and ``..`` segments or a trailing slash."""

    def keep(kept: Column, part: Column) -> Column:
        at_top = (F.size(kept) == 0) | (F.get(kept, F.size(kept) - 1) == "..")
        return F.when((part != "..") | at_top, F.array_append(kept, part)).otherwise(
            F.slice(kept, 1, F.size(kept) - 1)
        )

    def folded(path: Column) -> Column:
        segments = F.filter(F.split(path, "/"), lambda part: (part != "") & (part != "."))
        kept = F.aggregate(segments, F.array().cast("array<string>"), keep)
        return F.concat(F.lit("/"), F.array_join(kept, "/"))

    return _bind(
        path,
        lambda path: F.when(path.rlike(_NEEDS_NORMALISING), folded(path))
        .when(path == "/", path)
        .otherwise(F.regexp_replace(path, "/$", "")),
    )


def _raise(message: Column) -> Column:
    return F.raise_error(message).cast("string")


def qualify_path(path: Column | str, default_fs: str, working_dir: str) -> Column:
    """Make a path absolute and give it a scheme and authority.

    A relative path starts at ``working_dir``; a missing scheme comes from
    ``default_fs``, as does a missing authority where the scheme is the same.
    """
    path = _column(path)
    default_scheme, _, rest = default_fs.partition("://")
    default_authority = rest.partition("/")[0]

    scheme, authority, tail = _parts(path)
    full_scheme = F.when(scheme == "", F.lit(default_scheme)).otherwise(scheme)
    full_authority = F.when(
        (authority == "") & ((scheme == "") | (scheme == default_scheme)), F.lit(default_authority)
    ).otherwise(authority)
    absolute = (
        F.when(tail.startswith("/"), tail)
        .when((tail == "") & (authority != ""), F.lit("/"))
        .when(tail == "", _raise(F.concat(F.lit("no path: "), path)))
        .when(scheme == "", F.concat(F.lit(working_dir + "/"), tail))
        .otherwise(_raise(F.concat(F.lit("relative path after a scheme: "), path)))
    )
    return F.concat(full_scheme, F.lit("://"), full_authority, _normal_path(absolute))


def below(root: str) -> str:
    """The prefix shared by everything below ``root``."""
    return root.removesuffix("/") + "/"


def folder_of(uri: Column | str) -> Column:
    """The part of a URI up to its last slash, with it."""
    uri = _column(uri)
    return F.substr(uri, F.lit(1), F.length(uri) - F.length(F.substring_index(uri, "/", -1)))


def depth_of(uri: Column | str) -> Column:
    """How many slashes a URI has: larger for deeper entries of one filesystem."""
    uri = _column(uri)
    return F.length(uri) - F.length(F.replace(uri, F.lit("/"), F.lit("")))


def destination_of_root(source_root: str, destination_root: str) -> str:
    """Where the source root itself goes."""
    if source_root.endswith("/"):
        return destination_root
    return below(destination_root) + source_root.rpartition("/")[2]


def map_destination(uri: Column | str, source_root: str, destination_root: str) -> Column:
    """Where an entry of the source tree goes: below the destination, keeping the
    source root's own name (``/x/data/a`` -> ``<destination>/data/a``).

    Copying a whole filesystem maps its root to the destination itself. An entry
    outside the source root is an error.
    """
    uri = _column(uri)
    kept_from = len(source_root.removesuffix("/") if source_root.endswith("/") else source_root.rpartition("/")[0])
    mapped = F.concat(F.lit(destination_root.removesuffix("/")), _after(uri, kept_from))
    return (
        F.when(uri.startswith(below(source_root)) & (uri != source_root), mapped)
        .when(uri == source_root, F.lit(destination_of_root(source_root, destination_root)))
        .when(uri.isNotNull(), _raise(F.concat(uri, F.lit(" is not below " + source_root))))
    )


def uri_is_child(parent: Column | str, child: Column | str) -> Column:
    """Whether ``child`` is ``parent`` or lies below it, by whole path segments and
    within one scheme and authority. Both need a scheme and an absolute path."""
    parent, child = _column(parent), _column(child)

    def spelled(uri: Column) -> Column:
        scheme, authority, path = _parts(uri)
        return (
            F.when(scheme == "", _raise(F.concat(F.lit("no scheme: "), uri)))
            .when(~path.startswith("/"), _raise(F.concat(F.lit("no absolute path: "), uri)))
            .otherwise(F.concat(F.lower(scheme), F.lit("://"), authority, _normal_path(path)))
        )

    def inside(uris: Column) -> Column:
        outer, inner = uris["parent"], uris["child"]
        prefix = F.when(outer.endswith("/"), outer).otherwise(F.concat(outer, F.lit("/")))
        # "a/" contains what is below a, but not a itself.
        below_only = parent.endswith("/") & ~child.endswith("/") & ~outer.endswith("/")
        return inner.startswith(prefix) | ((inner == outer) & ~below_only)

    return _bind(F.struct(spelled(parent).alias("parent"), spelled(child).alias("child")), inside)


def classify_file_type(
    directory: Column | str, file: Column | str, uri: Column | str | None = None
) -> Column:
    """``directory`` or ``file``; anything else is an error."""
    name = F.lit("entry") if uri is None else _column(uri)
    return (
        F.when(_column(directory), F.lit(DIRECTORY))
        .when(_column(file), F.lit(FILE))
        .otherwise(_raise(F.concat(name, F.lit(" is neither a file nor a directory"))))
    )


def is_directory(file_type: Column | str = "file_type") -> Column:
    return _column(file_type) == DIRECTORY


def is_file(file_type: Column | str = "file_type") -> Column:
    return _column(file_type) == FILE


def ancestor_dependencies(uri: Column | str, root: str) -> Column:
    """The directories from ``root`` down to the entry's parent, root first, as
    ``array<struct<uri, len, file_type>>``; empty for the root itself."""
    uri = _column(uri)
    prefix = below(root)

    def folders(names: Column) -> Column:
        def folder(level: Column) -> Column:
            path = F.concat(F.lit(prefix), F.array_join(F.slice(names, 1, level), "/"))
            return F.struct(
                F.when(level == 0, F.lit(root)).otherwise(path).alias("uri"),
                F.lit(0).cast("bigint").alias("len"),
                F.lit(DIRECTORY).alias("file_type"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(names) - 1), folder)

    none = F.array().cast("array<struct<uri:string,len:bigint,file_type:string>>")
    return F.when(uri == root, none).otherwise(_bind(F.split(_after(uri, len(prefix)), "/"), folders))


def dependent_copies(ancestors: Column | str, source_root: str, destination_root: str) -> Column:
    """Each ancestor as a copy of its own: ``array<struct<source, destination>>``."""
    return F.transform(
        _column(ancestors),
        lambda folder: F.struct(
            folder["uri"].alias("source"),
            map_destination(folder["uri"], source_root, destination_root).alias("destination"),
        ),
    )


def exclude_paths(
    entries: DataFrame, patterns: Iterable[str] = EXCLUDE_PATTERNS, column: str = "uri"
) -> DataFrame:
    """Drop entries whose whole URI matches one of the patterns."""
    any_pattern = "|".join(f"(?:{pattern})" for pattern in patterns)
    return entries.where(~F.col(column).rlike(rf"\A(?:{any_pattern})\z")) if any_pattern else entries
