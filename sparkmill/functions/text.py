"""Scalar functions over command texts, paths, plan lines and JSON texts."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


_END = r"(?=$|[\s,.;!?])"
_TOKEN = (  # one token of a command: a unit with its particle, a comma with the space around it, space before a mark, other space, the rest
    rf"(?U)[AE]_ID\s*[은는이가을를]{_END}"
    rf"|(?<![A-Za-z0-9_])[AE]_\d{{2}}(?![A-Za-z0-9_])(?:\s*[은는이가을를]{_END})?"
    r"|\s*,(?:\s+(?=[.!?])|\s*)|\s+(?=[.!?])|\s+|[^\s,AE]+|."
)


def family_key(text: Column) -> Column:
    """A command's family: unit numbers and particles as place holders, one space between words, tidy punctuation. Null stays null.

    The text is cut into tokens once, and each token is written in its plain form; no token is looked at again.
    """

    def plain(t: Column) -> Column:
        unit, last = t.rlike(r"^[AE]_(?:(?U:\d{2})|ID\s*[은는이가을를]$)"), F.right(t, F.lit(1))
        particle = F.when(last.isin(*"은는이가"), "{JOSA_ST}").when(last.isin(*"을를"), "{JOSA_OBJ}").otherwise("")
        comma, space = t.rlike(r"(?U)^\s*,"), t.rlike(r"(?U)^\s+$")
        return F.when(unit, F.concat(F.left(t, F.lit(1)), F.lit("_ID"), particle)).when(comma, F.lit(", ")).when(space, F.lit(" ")).otherwise(t)

    tokens = F.regexp_extract_all(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(_TOKEN), F.lit(0))
    joined = F.array_join(F.transform(tokens, plain), "")
    return F.regexp_replace(F.regexp_replace(joined, " +([.!?])", "$1"), " +$", "")


def without_comment(line: Column) -> Column:
    """A plan line without its comment: # at the start or after white space begins one, any other # belongs to a path."""
    return F.regexp_replace(F.regexp_replace(line, r"(?U)(^|\s+)#.*$", ""), r"(?U)^\s+|\s+$", "")


def split_count(request: Column) -> Column:
    """struct(prefix, count) of "<prefix>.<count>"; both null where there is no count."""
    ok = request.rlike(r"^.*\.[0-9]+$")
    return F.struct(
        F.when(ok, F.regexp_extract(request, r"^(.*)\.([0-9]+)$", 1)).alias("prefix"),
        F.when(ok, F.regexp_extract(request, r"^(.*)\.([0-9]+)$", 2).try_cast("int")).alias("count"),
    )


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty; null if none is."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def stable_path(*parts: Column) -> Column:
    """Parts joined by dots, null as the word null."""
    return F.concat_ws(".", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def truncated(text: Column, width: int) -> Column:
    """A text of at most `width` characters, cut ones ending in an ellipsis; a width of 0 or less cuts nothing."""
    return text if width <= 0 else F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 1), F.lit("…"))).otherwise(text)


def unquoted(text: Column) -> Column:
    """A quoted JSON text as what it says; else the text without quotes around it."""
    asked = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]
    return F.when(text.rlike('^".*"$'), F.coalesce(asked, F.regexp_replace(text, '^"|"$', ""))).otherwise(text)


def listed(text: Column) -> Column:
    """The items of "a, b"; of an empty text and of {} none."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\{\}$", "")
    return F.filter(F.transform(F.split(inner, ","), lambda x: F.trim(x)), lambda x: x != "")


def without_fence(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(text), r"(?s)^```[A-Za-z]*\s*", ""), r"(?s)\s*```$", "")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def ids_in(text: Column, pattern: str) -> Column:
    """All matches of `pattern` in the order they are first seen, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def ratio_text(part: Column, whole: Column, target: Column) -> Column:
    """ "12.3%(24%) / 7": share, target share (- for none), count. No whole gives 0.0%."""
    share = F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))
    return F.concat(F.format_number(share, 1), F.lit("%("), F.coalesce(F.concat(target.cast("int").cast("string"), F.lit("%")), F.lit("-")), F.lit(") / "), part.cast("string"))


_OPENER = re.compile(r"[{\[]")


def found_json(text: str | None) -> str | None:
    """The JSON object or list that begins at the first opening bracket of a noisy text, as it is written there; None if none can be read there."""
    at = _OPENER.search(text or "")
    try:
        return text[at.start() : json.JSONDecoder().raw_decode(text, at.start())[1]] if at else None
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def first_json(text: pd.Series) -> pd.Series:
    """`found_json` of each text, in Arrow batches."""
    return text.map(found_json)


def _dropped(value, key: str | None):
    if isinstance(value, dict):
        return {k: _dropped(v, key) for k, v in value.items() if k != key}
    return [_dropped(v, key) for v in value] if isinstance(value, list) else value


def canonical_json(text: Column, without: str | None = None) -> Column:
    """JSON with sorted keys and no spaces, numbers as they are written (2 is not 2.0), without the key `without` at any depth. Null for what is not JSON."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return json.dumps(_dropped(json.loads(t), without), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            except (TypeError, ValueError, RecursionError):
                return None

        return s.map(one)

    return run(text)


def key_paths(text: Column, keys: list[str]) -> Column:
    """Where any of `keys` stands in a JSON text, as JSON paths in reading order; none for what is not JSON."""
    wanted = frozenset(keys)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        def walk(v, at):
            if isinstance(v, dict):
                for k, x in v.items():
                    if k in wanted:
                        yield f"{at}.{k}"
                    yield from walk(x, f"{at}.{k}")
            elif isinstance(v, list):
                for i, x in enumerate(v):
                    yield from walk(x, f"{at}[{i}]")

        def one(t):
            try:
                return list(walk(json.loads(t), "$"))
            except (TypeError, ValueError, RecursionError):
                return []

        return s.map(one)

    return run(text)


def strict_variant(text: Column) -> Column:
    """try_parse_json that also refuses trailing text: the text must parse inside a list of one and inside an object."""
    return F.when(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull(), F.try_parse_json(text))


def lenient_int(v: Column) -> Column:
    """A number of a JSON text as long if it is a whole one; booleans, texts and fractions give null."""
    return F.when(v.rlike(r"^-?[0-9]+(\.0+)?$"), v.try_cast("double").try_cast("long"))


def lenient_number(v: Column) -> Column:
    """A finite number of a JSON text as double; booleans, texts, NaN and infinities give null."""
    d = F.when(v.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), v.try_cast("double"))
    return F.when(F.abs(d) < float("inf"), d)


def lenient_bool(v: Column, default: bool) -> Column:
    """true or false of a JSON text; all else gives the default."""
    return F.when(v == "true", True).when(v == "false", False).otherwise(F.lit(default))
