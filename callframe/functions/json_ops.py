"""JSON as Column expressions.

Open JSON (tools, calls, arguments) is parsed into VARIANT once and then
inspected with path lookups and casts; all of it stays inside whole-stage
codegen. Three texts are used:

* ``compact(text)``   compact JSON, key order kept (``get_json_object``);
                      used wherever the reference prints JSON it parsed.
* ``canon(variant)``  compact JSON with sorted keys (``to_json``); used to
                      compare, group and hash values.
* the raw text         kept as it came, for traces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A string no real payload contains; text holding it is rejected.
_SENTINEL = "␞__callframe_end__"
# A type that an object casts to and that takes none of its values: a cast to it
# (to a list or a map of it) tells the shape of a value and copies nothing.
_SHAPE = "struct<>"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_json(df: DataFrame, src: str | Column, out: str) -> DataFrame:
    """Parse like Python's ``json.loads`` into VARIANT column ``out`` (NULL
    when invalid).

    ``try_parse_json`` alone accepts a valid prefix and drops the rest
    (``[1] x``). Parsing ``[text,{"<sentinel>":{}}]`` and requiring the sentinel
    at index 1 and nothing at index 2 rejects any tail, any extra element
    and any early close. The text is parsed once, in its own projection;
    later checks read that column. ``NaN``/``Infinity`` are rejected (Python
    accepts them; settled deviation).
    """
    text = _c(src)
    w, t = f"_{out}_w", f"_{out}_t"
    keep = [c for c in df.columns if c != out]
    df = df.withColumns({
        t: text,
        w: F.try_parse_json(_wrapped(text)),
    })
    return df.select(*keep, F.when(_ended(F.col(t), F.col(w)), F.try_variant_get(F.col(w), "$[0]", "variant")).alias(out))


def _wrapped(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(',{"' + _SENTINEL + '":{}}]'))


def _ended(text: Column, wrapped: Column) -> Column:
    """The wrapped text is one value and the sentinel."""
    return (~text.contains(_SENTINEL)
            & F.try_variant_get(wrapped, f"$[1]['{_SENTINEL}']", _SHAPE).isNotNull()
            & F.try_variant_get(wrapped, "$[2]", "variant").isNull())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside a lambda of
    a higher-order function (where no projection can name it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parsed(text: Column) -> Column:
    """``with_json`` as one expression, for use inside lambdas."""
    return let(F.try_parse_json(_wrapped(text)), lambda w: F.when(_ended(text, w), F.try_variant_get(w, "$[0]", "variant")))


def parse_empty_list() -> Column:
    return F.parse_json(F.lit("[]"))


def canon(v: Column | str) -> Column:
    """Canonical text of a VARIANT: compact, keys sorted, numbers normalised."""
    return F.to_json(_c(v))


def compact(text: Column | str, path: str = "$") -> Column:
    """Compact JSON text of (a path into) valid JSON text, key order kept."""
    return F.get_json_object(_c(text), path)


def as_array(v: Column | str) -> Column:
    """ARRAY<VARIANT> when the value is a JSON array, else NULL."""
    return _c(v).try_cast("array<variant>")


def as_object(v: Column | str) -> Column:
    """MAP<STRING, VARIANT> when the value is a JSON object, else NULL."""
    return _c(v).try_cast("map<string,variant>")


def as_array_of_objects(v: Column | str) -> Column:
    """ARRAY<MAP<STRING, VARIANT>> when the value is an array whose
    elements are objects or nulls (nulls stay NULL elements), else NULL."""
    return _c(v).try_cast("array<map<string,variant>>")


def is_array(v: Column | str) -> Column:
    """The value is a JSON array. (A cast reads one level; the value's schema
    would read all of it.)"""
    return _c(v).try_cast(f"array<{_SHAPE}>").isNotNull()


def is_object(v: Column | str) -> Column:
    """The value is a JSON object."""
    return _c(v).try_cast(_SHAPE).isNotNull()


def length(v: Column | str) -> Column:
    """How many elements a JSON array has, else NULL."""
    return F.array_size(_c(v).try_cast(f"array<{_SHAPE}>"))


def keys(v: Column | str) -> Column:
    """The keys of a JSON object, else NULL."""
    return F.map_keys(_c(v).try_cast(f"map<string,{_SHAPE}>"))


def kind(v: Column | str) -> Column:
    """Python-level kind of a JSON value: array, object, null, boolean,
    number or string; NULL for SQL NULL (absent). Containers are told by a
    cast of one level, so only scalars are asked for their type."""
    v = _c(v)
    word = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(is_object(v), F.lit("object")).when(is_array(v), F.lit("array"))
            .when(F.is_variant_null(v), F.lit("null"))
            .when(word == "STRING", F.lit("string")).when(word == "BOOLEAN", F.lit("boolean"))
            .otherwise(F.lit("number")))


def get(v: Column | str, key: str) -> Column:
    """``d[key]`` as VARIANT; SQL NULL when the key is absent or ``v`` is not
    an object. A JSON null value stays a (non-NULL) VARIANT null."""
    return F.try_variant_get(_c(v), "$['" + key.replace("'", "\\'") + "']", "variant")


def at(v: Column | str, index: int) -> Column:
    """``a[index]`` as VARIANT; NULL when out of range or not an array."""
    return F.try_variant_get(_c(v), f"$[{int(index)}]", "variant")


def has_key(v: Column | str, key: str) -> Column:
    return is_object(v) & get(v, key).isNotNull()


def as_string(v: Column | str) -> Column:
    """The string when the value is a JSON string, else NULL."""
    v = _c(v)
    return F.when(F.schema_of_variant(v) == "STRING", v.try_cast("string"))


def string_of(v: Column | str) -> Column:
    """``as_string`` by one cast: of all JSON values only a string casts to bytes."""
    return _c(v).try_cast("binary").cast("string")


def truthy(v: Column | str, k: Column | str) -> Column:
    """Python truthiness of a parsed JSON value ``v`` of kind ``k`` (a
    column from ``kind``; NULL counts as None)."""
    v, k = _c(v), _c(k)
    return (
        F.when(k.isNull() | (k == "null"), F.lit(False))
        .when(k == "array", length(v) > 0)
        .when(k == "object", F.size(keys(v)) > 0)
        .when(k == "boolean", v.try_cast("boolean"))
        .when(k == "string", F.length(v.try_cast("string")) > 0)
        .otherwise(v.try_cast("double") != 0)
    )


def py_str(v: Column | str, k: Column | str, missing: str = "") -> Column:
    """Python ``str()`` of a JSON value ``v`` of kind ``k``, as far as names
    need it: strings as they are, NULL (absent) as ``missing``, null as
    ``None``, booleans as ``True``/``False``, integers as digits, anything
    else as its JSON text marked so it cannot equal a real string name."""
    v, k = _c(v), _c(k)
    return (
        F.when(k.isNull(), F.lit(missing))
        .when(k == "string", v.try_cast("string"))
        .when(k == "null", F.lit("None"))
        .when(k == "boolean", F.when(v.try_cast("boolean"), F.lit("True")).otherwise(F.lit("False")))
        .when((k == "number") & F.schema_of_variant(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
              v.try_cast("string"))
        .otherwise(F.concat(F.lit("\u0000"), canon(v)))
    )


def is_variant_null(v: Column | str) -> Column:
    """The value is JSON ``null`` (not SQL NULL)."""
    return F.coalesce(F.is_variant_null(_c(v)), F.lit(False))


# -- comparing as Python does -----------------------------------------------------

_STRING = r'"(?:[^"\\]|\\.)*"'


def tokens(canonical: Column | str) -> Column:
    """The tokens of canonical JSON text: strings with their quotes, brackets,
    commas, colons, and numbers or words."""
    return F.regexp_extract_all(_c(canonical), F.lit(_STRING + r'|[\[\]{}:,]|[^\[\]{}:,"]+'), F.lit(0))


def _number_text(t: Column) -> Column:
    """One text for numbers that Python calls equal: integers as digits, also
    where they are written as decimals or with an exponent (beyond 2^53 by
    their shortest decimal text); booleans count as 0 and 1."""
    d = t.try_cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < F.lit(1e38))
    return (F.when(t == "true", F.lit("1")).when(t == "false", F.lit("0")).when(t == "null", t)
            .when(t.rlike("^-?[0-9]+$"), t)
            .when(whole, d.try_cast("decimal(38,0)").cast("string")).otherwise(d.cast("string")))


def python_text(toks: Column) -> Column:
    """Text that is equal for two values exactly if Python's ``==`` holds on
    what they parse to (keys are sorted already)."""
    return F.array_join(F.transform(toks, lambda t: F.when(t.rlike(r'^["\[\]{}:,]'), t).otherwise(_number_text(t))), "")


def value_kinds(toks: Column) -> Column:
    """MAP<path, kind> of a value and everything inside it: o, a, s, n (numbers
    and booleans, one kind to Python's arithmetic) or z (null).

    A fold over the tokens; its state is the stack of open containers (prefix
    of their paths, list or not, place in it), the last key, whether a key
    comes next, and the paths found. A step of a path is ``/place`` in a list
    and ``.key`` (with its quotes) in an object."""
    frame = "struct<prefix:string,list:boolean,place:int>"
    start = F.struct(F.array().cast(f"array<{frame}>").alias("stack"), F.lit("").alias("key"), F.lit(False).alias("key_next"),
                     F.array().cast("array<struct<path:string,kind:string>>").alias("found"))

    def step(s: Column, t: Column) -> Column:
        top = F.try_element_at(s["stack"], F.lit(-1))
        below = F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(0)))
        path = (F.when(top.isNull(), F.lit("")).when(top["list"], F.concat(top["prefix"], F.lit("/"), top["place"].cast("string")))
                .otherwise(F.concat(top["prefix"], F.lit("."), s["key"])))
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        is_key = s["key_next"] & t.startswith('"')
        value = ~is_key & ~closes & ~t.isin(",", ":")
        kind = (F.when(t == "{", F.lit("o")).when(t == "[", F.lit("a")).when(t.startswith('"'), F.lit("s"))
                .when(t == "null", F.lit("z")).otherwise(F.lit("n")))

        def framed(prefix: Column, is_list: Column, place: Column) -> Column:
            return F.array(F.struct(prefix.alias("prefix"), is_list.alias("list"), place.alias("place")))

        stack = (F.when(opens, F.concat(s["stack"], framed(path, t == "[", F.lit(0))))
                 .when(closes, below)
                 .when((t == ",") & top["list"], F.concat(below, framed(top["prefix"], top["list"], top["place"] + 1)))
                 .otherwise(s["stack"]))
        found = F.when(value, F.concat(s["found"], F.array(F.struct(path.alias("path"), kind.alias("kind"))))).otherwise(s["found"])
        key_next = F.when((t == "{") | ((t == ",") & ~F.coalesce(top["list"], F.lit(True))), F.lit(True)).otherwise(F.lit(False))
        return F.struct(stack.alias("stack"), F.when(is_key, t).otherwise(s["key"]).alias("key"),
                        key_next.alias("key_next"), found.alias("found"))

    return F.aggregate(toks, start, step, lambda s: F.map_from_entries(s["found"]))


def same_kinds(a: Column, b: Column) -> Column:
    """No path that both values (``value_kinds``) have holds different kinds."""
    # each map is worked out once; inside a lambda over the one the other would be, for every entry, again
    differ = F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x != y, F.lit(False)))
    return ~F.array_contains(F.map_values(differ), F.lit(True))
