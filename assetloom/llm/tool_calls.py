"""Tool-call linking for chat data.

Calls and results meet in a hash join on conversation and identifier. Calls are ordered topologically: a call comes one
level after the deepest call whose result its arguments name, and (level, position) is an order in which every call follows
what it needs. A reference is an object ``{"ref": id}`` with that one key, anywhere below the top of the arguments; a
parameter that happens to be called ``ref`` is none. Arguments are checked against the JSON schema of their tool and
everything is written as canonical JSON (sorted keys, no spaces, whole numbers without fraction).

Only pairs of identifiers are grouped by conversation, and only where they number at most ``GROUP``: these are ordered in
one pass. A larger conversation is ordered by joins, in rounds that settle the calls which wait for nothing; before, every
call that waits for one call alone points past it by doubling, so that a chain takes the logarithm of its length. Calls
themselves are never grouped, so a conversation may hold any share of the rows. Schemas join by tool name.

Status, the first that holds: ``orphan_result`` (no such call), ``duplicate_id`` (a later call under a used identifier),
``cyclic`` (on a cycle or behind one), ``unknown_tool``, ``unusable_schema``, ``invalid_arguments``, ``missing_result``,
``ok``. Null identifiers link to nothing: such calls miss their result and such results are orphans. Repeated equal rows
count once. Further results of a call are counted in ``n_results`` and the first is linked. Other columns are not read.

No value ends the job. Arguments that are not JSON, repeat a key, hold unpaired surrogates or numbers beyond a double or
4300 digits, or nest deeper than ``DEPTH`` are invalid and are recorded as the text they came as. A schema that is not
JSON, uses a keyword outside ``KEYWORDS`` or gives one a value of the wrong kind is unusable, and so are two different
schemas under one name.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.session import checkpointed

_KEY = ["conv_id", "call_id"]
#: How deep arguments and schemas may nest.
DEPTH = 200
#: Up to how many references of a conversation are ordered in one pass (two identifiers each).
GROUP = 200_000


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``conv_id, call_id, position, level, status, n_results, problems, record`` for each call and orphan result.

    ``calls``: ``conv_id, call_id, position, name, arguments`` (JSON); ``results``: ``conv_id, call_id, position, content``;
    ``schemas``: ``name, schema`` (JSON).
    """
    asked = calls.select(*_KEY, "position", "name", "arguments").distinct()
    first = asked.where("call_id IS NOT NULL").groupBy(*_KEY).agg(F.min(F.struct(
        "position", "name", "arguments")).alias("first"))
    same = F.struct("position", "name", "arguments") == F.col("first")
    asked = _matched(asked, first, "left").withColumn("is_first", F.coalesce(same, F.lit(True))).drop("first")
    asked = checkpointed(asked)
    asked_levels = _levels(asked.where("is_first AND call_id IS NOT NULL"))
    answers = results.select(*_KEY, "position", "content").distinct()
    answered = answers.where("call_id IS NOT NULL").groupBy(*_KEY).agg(
        F.min(F.struct("position", "content")).alias("answer"), F.count(F.lit(1)).alias("n_results"))
    whole = _matched(asked, answered, "left").withColumns({
        "content": F.col("answer.content"), "n_results": F.coalesce("n_results", F.lit(0))}).drop("answer")
    whole = _matched(whole, asked_levels, "left").withColumn("level", F.when(
        F.col("call_id").isNotNull(), F.nullif(F.coalesce("level", F.lit(0)), F.lit(-1))))
    named = schemas.where("name IS NOT NULL").groupBy("name").agg(
        F.coalesce(F.min("schema"), F.lit("")).alias("schema"),
        F.count_distinct(F.coalesce("schema", F.lit(""))).alias("n_schemas"))
    whole = whole.join(named, "name", "left")
    known = first.select(*_KEY)
    orphans = _matched(answers, known, "left_anti").select(
        *_KEY, "position", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("boolean").alias("is_first"), "content", F.lit(1).cast("long").alias("n_results"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("schema"),
        F.lit(None).cast("long").alias("n_schemas"))
    rows = whole.unionByName(orphans)
    kinds = dict(rows.dtypes)
    return rows.mapInPandas(_written, f"conv_id {kinds['conv_id']}, call_id {kinds['call_id']}, position "
                            f"{kinds['position']}, level int, status string, n_results long, problems string, record string")


def _matched(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on conversation and identifier; null conversations are equal, null identifiers match nothing."""
    right = right.withColumnsRenamed({"conv_id": "_conv", "call_id": "_call"})
    joined = left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("call_id") == F.col("_call")), how)
    return joined.drop("_conv", "_call")


def _levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of the calls that wait for another; -1 on a cycle or behind one."""
    kinds = dict(calls.dtypes)
    pairs = f"conv_id {kinds['conv_id']}, call_id {kinds['call_id']}"
    named = calls.where(r"arguments RLIKE 'ref|\\\\u'").select(*_KEY, "arguments").mapInPandas(
        _references, f"{pairs}, needs string")
    there = calls.select(F.col("conv_id").alias("in_conv"), F.col("call_id").alias("known"))
    waits = checkpointed(named.join(there, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (
        F.col("needs") == F.col("known").cast("string"))).select(*_KEY, F.col("known").alias("needs")))
    sizes = waits.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > GROUP).select(F.col("conv_id").alias("c"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    small = waits.join(large, same, "left_anti").groupBy("conv_id").agg(F.collect_list(F.struct("call_id", "needs")).alias("waits"))
    levels = small.mapInPandas(_ordered, f"{pairs}, level int")
    if large.isEmpty():
        return levels
    return levels.unionByName(_levels_by_joins(checkpointed(waits.join(large, same, "left_semi"))))


def _references(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [(row.conv_id, row.call_id, x) for row in frame.itertuples(index=False) for x in references(row.arguments)]
        yield pd.DataFrame({name: pd.Series([f[k] for f in found], dtype=kind) for k, (name, kind) in enumerate(
            (("conv_id", frame["conv_id"].dtype), ("call_id", frame["call_id"].dtype), ("needs", object)))})


def references(text: str) -> list[str]:
    """The identifiers that arguments name, each once."""
    try:
        open_, found = [parsed(text)], {}
    except ValueError:
        return []
    top = True
    while open_:
        value = open_.pop()
        if isinstance(value, dict):
            if not top and list(value) == ["ref"] and isinstance(value["ref"], str):
                found[value["ref"]] = None
            open_.extend(value.values())
        elif isinstance(value, list):
            open_.extend(value)
        top = False
    return list(found)


def _ordered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [(conv, call, level) for conv, waits in zip(frame["conv_id"], frame["waits"])
                 for call, level in ordered((w["call_id"], w["needs"]) for w in waits).items()]
        yield pd.DataFrame({name: pd.Series([f[k] for f in found], dtype=kind) for k, (name, kind) in enumerate(
            (("conv_id", frame["conv_id"].dtype), ("call_id", object), ("level", "int32")))})


def ordered(waits) -> dict:
    """The level of each call that waits, by settling the calls which wait for nothing more; -1 on or behind a cycle."""
    needed_by: dict = {}
    open_: dict = {}
    for call, needs in waits:
        needed_by.setdefault(needs, []).append(call)
        open_[call] = open_.get(call, 0) + 1
    level = dict.fromkeys(open_, -1)
    settled, at = [x for x in needed_by if x not in open_], 0
    while settled:
        at, after = at + 1, []
        for x in settled:
            for call in needed_by.get(x, ()):
                open_[call] -= 1
                if not open_[call]:
                    level[call] = at
                    after.append(call)
        settled = after
    return level


def _levels_by_joins(waits: DataFrame) -> DataFrame:
    """As ``ordered`` for waits (``conv_id, call_id, needs``) of any number."""
    calls = checkpointed(waits.select(*_KEY).distinct())
    edges = checkpointed(_past_single_waits(waits, calls.count()).withColumn("reached", F.lit(None).cast("long")))
    known = waits.select("conv_id", F.col("needs").alias("call_id")).distinct()
    settled = checkpointed(_matched(known, calls, "left_anti").withColumn("level", F.lit(0).cast("long")))
    levels = []
    while not settled.isEmpty():
        there = settled.select(F.col("conv_id").alias("c"), F.col("call_id").alias("settled"), F.col("level").alias("before"))
        met = edges.join(there, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("needs") == F.col("settled")), "left")
        edges = checkpointed(met.withColumn("reached", F.coalesce("reached", F.col("before") + F.col("steps"))).drop(
            "c", "settled", "before"))
        sums = edges.groupBy(*_KEY).agg(F.max("reached").alias("level"), F.count("reached").alias("n"),
                                        F.count(F.lit(1)).alias("edges"))
        settled = checkpointed(sums.where("n = edges").select(*_KEY, "level"))
        edges = checkpointed(_matched(edges, settled.select(*_KEY), "left_anti"))
        levels.append(settled)
        if len(levels) == 16:
            levels = [checkpointed(reduce(DataFrame.unionByName, levels))]
    found = reduce(DataFrame.unionByName, levels) if levels else calls.withColumn("level", F.lit(-1).cast("long"))
    return _matched(calls, found, "left").select(*_KEY, F.coalesce("level", F.lit(-1)).cast("int").alias("level"))


def _past_single_waits(waits: DataFrame, n: int) -> DataFrame:
    """The waits with ``steps``: none is for a call that itself waits for one call alone, but that call's wait is added."""
    one = waits.groupBy(*_KEY).agg(F.min("needs").alias("to"), F.count(F.lit(1)).alias("n")).where("n = 1")
    jump = checkpointed(one.select(*_KEY, "to", F.lit(1).cast("long").alias("further")))
    there = lambda: jump.select(F.col("conv_id").alias("c"), F.col("call_id").alias("via"), F.col("to").alias("next"),
                                F.col("further").alias("more"))
    meets = lambda needs: F.col("conv_id").eqNullSafe(F.col("c")) & (F.col(needs) == F.col("via"))
    for _ in range(n.bit_length()):
        # On a cycle of single waits this never ends by itself; no path is longer than n.
        longer = jump.join(there(), meets("to"), "left")
        if longer.where("via IS NOT NULL").isEmpty():
            break
        jump = checkpointed(longer.select(*_KEY, F.coalesce("next", "to").alias("to"), F.least(
            F.lit(n), F.col("further") + F.coalesce("more", F.lit(0))).cast("long").alias("further")))
    return waits.join(there(), meets("needs"), "left").select(
        *_KEY, F.coalesce("next", "needs").alias("needs"), (F.coalesce("more", F.lit(0)) + 1).alias("steps"))


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, whole numbers without fraction, text as it is."""
    return json.dumps(_plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() and abs(value) < 2**53 else value


def _no_repeats(pairs: list) -> dict:
    if len(dict(pairs)) < len(pairs):
        raise ValueError("repeated key")
    return dict(pairs)


def _refuse(name: str):
    raise ValueError("not JSON")


def _finite(text: str) -> float:
    value = float(text)
    if math.isinf(value):
        raise ValueError("number too large")
    return value


def parsed(text: str):
    """The value of a JSON text; a ValueError says why it has none."""
    if text.count("[") + text.count("{") > DEPTH and _depth(text) > DEPTH:
        raise ValueError(f"nested deeper than {DEPTH}")
    try:
        value = json.loads(text, object_pairs_hook=_no_repeats, parse_constant=_refuse, parse_float=_finite)
    except json.JSONDecodeError:
        raise ValueError("not JSON") from None
    if "\\u" in text:
        try:
            json.dumps(value, ensure_ascii=False).encode()
        except UnicodeEncodeError:
            raise ValueError("unpaired surrogate") from None
    return value


def _depth(text: str) -> int:
    depth = deepest = 0
    for token in _BRACKET.finditer(text):
        if token[0] in "[{":
            depth += 1
            deepest = max(deepest, depth)
        elif token[0] in "]}":
            depth -= 1
    return deepest


#: A bracket, or a string in which brackets do not count.
_BRACKET = re.compile(r'[\[\]{}]|"(?:[^"\\]|\\.)*+"', re.S)
#: Fixed values of JSON Schema: types, and the keywords that are checked or, as notes, need no check.
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_NUMBERS = frozenset("minimum maximum exclusiveMinimum exclusiveMaximum".split())
_SIZES = frozenset("minLength maxLength minItems maxItems minProperties maxProperties".split())
_CHOICES = frozenset("anyOf allOf oneOf".split())
_NOTES = frozenset("title description default examples deprecated readOnly writeOnly format $schema $id $comment".split())
KEYWORDS = frozenset("type enum const required properties additionalProperties items not".split()) | (
    _NUMBERS | _SIZES | _CHOICES | _NOTES)


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _is_a(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return _is_number(value) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, _TYPES[kind])


def usable(schema) -> bool:
    """Whether every keyword of a schema is known and has a value of its kind."""
    if isinstance(schema, bool):
        return True
    if not isinstance(schema, dict) or not KEYWORDS.issuperset(schema):
        return False
    kinds = schema.get("type", [])
    names = lambda x: isinstance(x, list) and all(isinstance(k, str) for k in x)
    return (
        all(k in _TYPES or k in ("integer", "number") for k in ([kinds] if isinstance(kinds, str) else kinds))
        if isinstance(kinds, str) or names(kinds) else False
    ) and isinstance(schema.get("enum", []), list) and names(schema.get("required", [])) and (
        all(_is_number(schema[k]) for k in _NUMBERS & schema.keys())) and (
        all(_is_a(schema[k], "integer") and schema[k] >= 0 for k in _SIZES & schema.keys())) and (
        isinstance(schema.get("properties", {}), dict) and all(map(usable, schema.get("properties", {}).values()))) and (
        all(isinstance(schema[k], list) and schema[k] and all(map(usable, schema[k])) for k in _CHOICES & schema.keys())) and (
        all(usable(schema[k]) for k in ("items", "additionalProperties", "not") if k in schema))


def problems(value, schema, at: str = "$") -> Iterator[str]:
    """What a value breaks of a usable schema."""
    if isinstance(schema, bool):
        yield from () if schema else (f"{at}: not allowed",)
        return
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is_a(value, k) for k in kinds):
        yield f"{at}: not {' or '.join(kinds)}"
        return
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        yield f"{at}: not one of the values"
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        yield f"{at}: not the value"
    for keyword in sorted(_CHOICES & schema.keys()):
        fits = sum(next(problems(value, s, at), None) is None for s in schema[keyword])
        if not (fits == 1 if keyword == "oneOf" else fits == len(schema[keyword]) if keyword == "allOf" else fits):
            yield f"{at}: {keyword}"
    if "not" in schema and next(problems(value, schema["not"], at), None) is None:
        yield f"{at}: not"
    if isinstance(value, dict):
        known, rest = schema.get("properties", {}), schema.get("additionalProperties", True)
        yield from (f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value)
        if not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value)):
            yield f"{at}: size"
        for k in sorted(value):
            if k not in known and rest is False:
                yield f"{at}.{k}: unknown"
            else:
                yield from problems(value[k], known.get(k, rest), f"{at}.{k}")
    elif isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            yield f"{at}: size"
        for i, x in enumerate(value):
            yield from problems(x, schema.get("items", True), f"{at}[{i}]")
    elif isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            yield f"{at}: length"
    elif _is_number(value):
        if (value < schema.get("minimum", value) or value > schema.get("maximum", value)
                or value <= schema.get("exclusiveMinimum", -math.inf) or value >= schema.get("exclusiveMaximum", math.inf)):
            yield f"{at}: range"


def _written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    schemas: dict = {}
    for frame in frames:
        rows = [_judged(row, schemas) for row in frame.itertuples(index=False)]
        out = frame[["conv_id", "call_id", "position"]].copy()
        out["level"] = frame["level"].astype("Int32")
        out["n_results"] = frame["n_results"]
        for k, name in enumerate(("status", "problems", "record")):
            out[name] = pd.Series([r[k] for r in rows], index=out.index, dtype=object)
        yield out[["conv_id", "call_id", "position", "level", "status", "n_results", "problems", "record"]]


def _text(value) -> str | None:
    return None if value is None or value is pd.NA or isinstance(value, float) else value


def _schema(text: str):
    """The schema, or None where it is unusable."""
    try:
        schema = parsed(text)
    except ValueError:
        return None
    return schema if usable(schema) else None


def _judged(row, schemas: dict) -> tuple[str, str, str]:
    """Status, problems and canonical record of a call or an orphan result."""
    call_id, content = _text(row.call_id), _text(row.content)
    if row.is_first is None or row.is_first is pd.NA:
        return "orphan_result", "", canonical({"call_id": call_id, "result": content})
    name, written, found = _text(row.name), _text(row.arguments), []
    try:
        arguments = parsed(written or "")
    except ValueError as why:
        reason = str(why) if len(why.args) == 1 and not str(why).startswith("Exceeds") else "number too long"
        arguments, found = written, [f"$: {reason}"]
    schema_text = _text(row.schema)
    if schema_text is not None and schema_text not in schemas:
        schemas[schema_text] = _schema(schema_text)
    schema = schemas.get(schema_text) if schema_text is not None and row.n_schemas == 1 else None
    if schema is not None and not found:
        found = list(problems(arguments, schema))
    if not row.is_first:
        status = "duplicate_id"
    elif pd.isna(row.level) and call_id is not None:
        status = "cyclic"
    elif schema_text is None:
        status = "unknown_tool"
    elif schema is None:
        status = "unusable_schema"
    elif found:
        status = "invalid_arguments"
    else:
        status = "ok" if row.n_results else "missing_result"
    return status, "; ".join(found), canonical(
        {"arguments": arguments, "call_id": call_id, "name": name, "result": content})
