"""Front matter with value types: keys, scalars, lists, nested maps, quoted and block values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain scalars that are no strings, as YAML 1.1 resolves them.
NULLS = "^(~|null|Null|NULL|)$"
BOOLS = "^(yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF)$"
INTS = "^[-+]?(0b[01_]+|0x[0-9a-fA-F_]+|0[0-7_]*|[1-9][0-9_]*(:[0-5]?[0-9])*)$"
FLOATS = r"^([-+]?([0-9][0-9_]*\.[0-9_]*|\.[0-9][0-9_]*)([eE][-+][0-9]+)?|[-+]?\.(inf|Inf|INF)|\.(nan|NaN|NAN))$"
DATES = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMES = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([Tt]|[ \t]+)[0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]*)?([ \t]*(Z|[-+][0-9]{1,2}(:[0-9]{2})?))?$"
# Marks that no plain scalar begins with; anchors, aliases and tags are not taken.
NOT_PLAIN = r"^([@`%&*!|>,\]}]|[?:-]([ \t]|$))"

_SPACE = r"^[ \t]+|[ \t]+$"
_IDLE = r"^[ \t]*(#.*)?$"
_KEY = r"^(\"[^\"]*\"|'[^']*'|[^\"':].*?)[ \t]*:(?:[ \t]+(.*))?$"
_BLOCK = r"^[|>][-+]?[1-9]?[-+]?[ \t]*(#.*)?$"
_ITEM = r"^ *-([ \t]|$)"
_FLOW = r"[ \t]*(\"[^\"]*\"|'[^']*'|\[[^\]]*\]|\{[^}]*\}|[^,\[\]{}\"'][^,\[\]{}]*|)[ \t]*,"

ITEM_TYPE = "struct<kind:string,text:string>"
#: A value: its kind (str, int, float, bool, null, date, time, list, map, error), its text, and the items of a list.
ENTRY_TYPE = f"array<struct<path:string,kind:string,text:string,items:array<{ITEM_TYPE}>>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE, "")


def _pair(kind, text: Column) -> Column:
    return F.struct((kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), text.alias("text"))


def _plain(raw: Column) -> Column:
    def typed(v: Column) -> Column:
        kind = (
            F.when(v.rlike(NOT_PLAIN) | v.rlike(r":([ \t]|$)"), "error").when(v.rlike(NULLS), "null").when(v.rlike(BOOLS), "bool")
            .when(v.rlike(INTS), "int").when(v.rlike(FLOATS), "float").when(v.rlike(TIMES), "time")
            .when(v.rlike(DATES) & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), "date").otherwise("str")
        )
        return _pair(kind, v)

    return _let(_strip(F.regexp_replace(raw, r"(^|[ \t])#.*$", "")), typed)


def _quoted(raw: Column, mark: str, masked: Column, text: Callable[[Column], Column]) -> Column:
    """A value between marks; after the closing one only a comment may follow."""
    end = F.locate(mark, masked, 2)
    inside = F.substring(raw, F.lit(2), end - 2)
    closed = (end > 0) & F.substring(raw, end + 1, F.length(raw)).rlike(r"^([ \t]+#.*|[ \t]*)$")
    return F.when(closed, _pair("str", text(inside))).otherwise(_pair("error", raw))


def _replacer(old: str, new: str) -> Callable[[Column], Column]:
    return lambda p: F.replace(p, F.lit(old), F.lit(new))


def _unescaped(inside: Column) -> Column:
    """Escapes of quotes, slashes, line ends and tabs; others stay as written."""
    parts = F.split(inside, r"\\\\")
    for escape, char in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ('\\"', '"'), ("\\/", "/")):
        parts = F.transform(parts, _replacer(escape, char))
    return F.array_join(parts, "\\")


def scalar(raw: Column) -> Column:
    """struct(kind, text) of a plain or quoted value."""

    def read(v: Column) -> Column:
        double = _quoted(v, '"', F.regexp_replace(v, r"\\.", "xx"), _unescaped)
        after = F.replace(F.substring(v, F.lit(2), F.length(v)), F.lit("''"), F.lit("xx"))
        single = _quoted(v, "'", F.concat(F.lit("'"), after), lambda t: F.replace(t, F.lit("''"), F.lit("'")))
        flow = F.when(v.startswith("["), "list").when(v.startswith("{"), "map")
        return F.when(v.startswith('"'), double).when(v.startswith("'"), single).when(flow.isNotNull(), _pair(flow, v)).otherwise(_plain(v))

    return _let(_strip(raw), read)


def _value(kind, text: Column, items: Column | None = None) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    items = F.lit(None).cast(f"array<{ITEM_TYPE}>") if items is None else items
    return F.struct(kind.alias("kind"), text.alias("text"), items.alias("items"))


def _inline(raw: Column) -> Column:
    """A value on the line of its key: a scalar, ``[a, b]`` or ``{a: b}``."""

    def read(v: Column) -> Column:
        bare = F.regexp_replace(v, r"[ \t]+#[^\]}]*$", "")
        inside = F.regexp_replace(F.regexp_extract(bare, r"^\[(.*)\]$", 1), r"[ \t]*,?[ \t]*$", "")
        items = F.when(_strip(inside) == "", F.array().cast(f"array<{ITEM_TYPE}>")).otherwise(
            F.transform(F.regexp_extract_all(F.concat(inside, F.lit(",")), F.lit(_FLOW), F.lit(1)), scalar)
        )
        read_all = F.regexp_replace(F.concat(inside, F.lit(",")), _FLOW, "") == ""
        listed = F.when(bare.endswith("]") & read_all, _value("list", v, items)).otherwise(_value("error", v))
        mapped = F.when(bare.endswith("}"), _value("map", v)).otherwise(_value("error", v))
        one = _let(scalar(v), lambda s: _value(s["kind"], s["text"]))
        return F.when(v.startswith("["), listed).when(v.startswith("{"), mapped).otherwise(one)

    return _let(_strip(raw), read)


def _indent(line: Column) -> Column:
    return F.length(F.regexp_extract(line, "^( *)", 1))


def _first(lines: Column) -> Column:
    """The first line that says something; null if none does."""
    return F.get(F.filter(lines, lambda x: ~x.rlike(_IDLE)), F.lit(0))


def _block_text(head: Column, rest: Column) -> Column:
    """Lines below ``|`` (kept) or ``>`` (joined), with the end that ``-`` or ``+`` asks for."""
    first = F.get(F.filter(rest, lambda x: ~x.rlike(r"^[ \t]*$")), F.lit(0))
    cut = _let(_indent(first), lambda depth: F.array_join(F.transform(rest, lambda x: F.substring(x, depth + 1, F.length(x))), "\n"))

    def ended(text: Column) -> Column:
        kept = F.regexp_replace(text, r"\n+\z", "")
        kept = F.when(head.startswith("|"), kept).otherwise(
            F.regexp_replace(F.regexp_replace(kept, r"(?<!\n)\n(?!\n)", " "), r"\n(\n+)", "$1")
        )
        end = F.when(head.rlike(r"^.[1-9]?-"), F.lit("")).when(head.rlike(r"^.[1-9]?\+"), F.concat(F.regexp_extract(text, r"(\n*)\z", 1), F.lit("\n")))
        return F.concat(kept, end.otherwise(F.when(kept == "", F.lit("")).otherwise(F.lit("\n"))))

    return _let(cut, ended)


def _starts(lines: Column, begins: Callable[[Column], Column]) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: begins(F.get(lines, i)))


def _pieces(lines: Column, starts: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make(line, lines up to the next start)`` for each start."""
    return F.transform(
        starts,
        lambda s, k: make(F.get(lines, s), F.slice(lines, s + 2, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s - 1)),
    )


def _folded(first: Column, rest: Column) -> Column:
    """A value that goes on over lines, joined by blanks."""
    return F.array_join(F.filter(F.transform(F.concat(F.array(first), rest), _strip), lambda x: x != ""), " ")


def _list(rest: Column) -> Column:
    """Items of ``- a`` lines; an item that is a map stays text."""

    def items(held: Column) -> Column:
        starts = _let(_indent(_first(held)), lambda depth: _starts(held, lambda x: x.rlike(_ITEM) & (_indent(x) == depth)))
        item = lambda line, more: _folded(F.regexp_replace(line, "^ *-", ""), more)
        texts = _let(starts, lambda s: _pieces(held, s, item))
        is_map = lambda t: t.rlike(_KEY) & ~t.rlike(r"^[\"'\[{]")
        return F.transform(texts, lambda t: F.when(is_map(t), _pair("map", t)).otherwise(scalar(t)))

    return _let(F.filter(rest, lambda x: ~x.rlike(_IDLE)), items)


def _grouped(head: Column, rest: Column) -> Column:
    """The value of a key from its line and the lines below."""

    def read(v: Column) -> Column:
        empty = v.rlike(_IDLE)

        def below(first: Column) -> Column:
            text = F.array_join(rest, "\n")
            return (
                F.when(v.rlike(_BLOCK), _value("str", _block_text(v, rest)))
                .when(empty & first.isNull(), _value("null", F.lit("")))
                .when(empty & first.rlike(_ITEM), _value("list", text, _list(rest)))
                .when(empty & _strip(first).rlike(_KEY) & ~first.rlike(r"^ *[\[{]"), _value("map", text))
                .otherwise(_inline(F.when(F.size(rest) == 0, v).otherwise(_folded(F.when(empty, F.lit("")).otherwise(v), F.filter(rest, lambda x: ~x.rlike(_IDLE))))))
            )

        return _let(_first(rest), below)

    return _let(_strip(head), read)


def _level(lines: Column) -> Column:
    """Entries of the map that these lines hold, with the lines below each key."""

    def level(held: Column) -> Column:
        def entry(line: Column, rest: Column) -> Column:
            key = scalar(F.regexp_extract(line, _KEY, 1))

            def made(v: Column, k: Column) -> Column:
                fits = line.rlike(_KEY) & ~k["kind"].isin("error", "list", "map")
                return F.struct(
                    F.when(fits, k["text"]).alias("path"), F.when(fits, k["kind"]).alias("key_kind"),
                    F.when(fits, v["kind"]).otherwise("error").alias("kind"),
                    F.when(fits, v["text"]).otherwise(line).alias("text"), v["items"].alias("items"), rest.alias("rest"),
                )

            return _let(key, lambda k: _let(_grouped(F.regexp_extract(line, _KEY, 2), rest), lambda v: made(v, k)))

        starts = _starts(held, lambda x: x.rlike(r"^([^\s#-]|-[^\s])"))
        return _let(starts, lambda s: _pieces(held, s, entry))

    def dedented(depth: Column) -> Column:
        cut = lambda x: F.when(_indent(x) >= depth, F.substring(x, depth + 1, F.length(x))).when(x.rlike(_IDLE), F.lit("")).otherwise(F.concat(F.lit(": "), x))
        return _let(F.transform(lines, cut), level)

    return _let(F.coalesce(_indent(_first(lines)), F.lit(0)), dedented)


def entries(front: Column) -> Column:
    """Entries (``ENTRY_TYPE``) of a front matter, in order; ``a.b`` is key b in the map a.

    Maps are opened one level below the top, deeper ones are of kind map with their text.
    A line that is no entry has a null path and kind error.  Null for null; an empty text
    has no entries.  Of a repeated key the last counts (``find``).
    """

    def opened(top: Column) -> Column:
        def inner(e: Column) -> Column:
            nested = (e["kind"] == "map") & ~e["text"].startswith("{")
            below = F.transform(_level(e["rest"]), lambda c: F.struct(F.concat_ws(".", e["path"], c["path"]).alias("path"), c["kind"], c["text"], c["items"]))
            own = F.array(F.struct(e["path"], e["kind"], e["text"], e["items"]))
            return F.when(nested, F.concat(own.cast(ENTRY_TYPE), below.cast(ENTRY_TYPE))).otherwise(own.cast(ENTRY_TYPE))

        return F.flatten(F.transform(top, inner))

    lines = F.split(F.regexp_replace(front, r"\r(?=\n|\z)", ""), "\n")
    return F.when(front.isNotNull(), _let(_let(lines, _level), opened))


def find(found: Column, path: str) -> Column:
    """The last entry of a path; null where there is none."""
    held = F.filter(found, lambda e: e["path"] == path)
    return F.get(held, F.size(held) - 1)


def parses(found: Column) -> Column:
    """No entry is an error."""
    return ~F.exists(found, lambda e: (e["kind"] == "error") | F.exists(F.coalesce(e["items"], F.array()), lambda i: i["kind"] == "error"))


def is_mapping(found: Column) -> Column:
    return F.exists(found, lambda e: e["path"].isNotNull())
