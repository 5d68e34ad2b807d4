"""Chat-template rendering of ``conversations`` as DataFrame expressions.

Input: ``conv_id, turn, role, text`` (turn = 0-based position of the message
in its conversation) and optionally ``reasoning STRING`` and
``tool_calls ARRAY<STRUCT<name STRING, arguments ARRAY<STRUCT<key, value>>>>``
(ordered arguments; a MAP<STRING, STRING> is accepted too; values already
JSON text for maps/lists, plain text otherwise);
optional per-conversation ``tools``, as structs (:func:`tools_preamble`) or as JSON text (:func:`tools_preamble_json`).

Messages of a conversation stand in the order of (turn, role, text), nulls first, whatever gaps, repeats or nulls the turn numbers
have; messages that are equal in all three keep any order, which no result shows.

Plan: one range-partitioned sort by conversation and that order, written once, gives every message a place; a long conversation
spreads over many partitions. Facts about neighbours and the whole conversation come from a scan in segments: windows over
chunks of at most ``SCAN_ROWS`` rows, totals per chunk and conversation, and carries from those totals, joined back by chunk. Each
message is rendered by a row-local expression; the final text of a conversation is the ordered concatenation of its
segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokscope.functions import json_text as js
from tokscope.functions.text import strip
from tokscope.session import materialised

CHUNK_TURNS = 256   # turns concatenated per task before the per-conversation concat
SCAN_ROWS = 4_096   # messages in a window of the scan

# --- fixed values: template markup -------------------------------------------
IM_START = "<|im_start|>"
IM_END = "<|im_end|>\n"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
EMPTY_THINK = "<think></think>"
TOOL_RESPONSE_OPEN = "<tool_response>\n"
TOOL_RESPONSE_CLOSE = "\n</tool_response>\n"
GEN_PROMPT_THINKING = "<|im_start|>assistant\n<think>\n"
GEN_PROMPT_NO_THINKING = "<|im_start|>assistant\n<think></think>"
TOOLS_HEADER = "# Tools\n\nYou have access to the following functions:\n\n<tools>"
TOOLS_FOOTER = "\n</tools>"
TOOLS_INSTRUCTIONS = (
    "\n\nIf you choose to call a function ONLY reply in the following format with NO suffix:\n\n"
    "<tool_call>\n<function=example_function_name>\n<parameter=example_parameter_1>\nvalue_1\n"
    "</parameter>\n<parameter=example_parameter_2>\nThis is the value for the second parameter\n"
    "that can span\nmultiple lines\n</parameter>\n</function>\n</tool_call>\n\n<IMPORTANT>\nReminder:\n"
    "- Function calls MUST follow the specified format: an inner <function=...></function> block must be "
    "nested within <tool_call></tool_call> XML tags\n- Required parameters MUST be specified\n"
    "- You may provide optional reasoning for your function call in natural language BEFORE the function "
    "call, but NOT after\n- If there is no function call available, answer the question like normal with "
    "your current knowledge and do not tell the user about function calls\n</IMPORTANT>")
# -----------------------------------------------------------------------------


def _lit(s: str) -> Column:
    return F.lit(s)


def positions(msgs: DataFrame, scan_rows: int | None = None) -> DataFrame:
    """``msgs`` with pos (0, 1, ... in the order of (turn, role, text), nulls first), prev_role, next_role, first_role and last_user
    (position of the last user message, -1 if none). No window holds more than ``scan_rows`` messages."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    placed = materialised(msgs.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "messages")
    chunk = F.floor(F.col("_place") / (scan_rows or SCAN_ROWS))     # the upper bits are the partition, so no chunk crosses one
    rows = placed.withColumn("_chunk", chunk)
    w = Window.partitionBy("_chunk", "conv_id").orderBy("_place")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", (F.row_number().over(w) - 1).alias("_in"), F.lag("role").over(w).alias("_prev"), F.lead("role").over(w).alias("_next"),
                       (F.row_number().over(w) == F.count(F.lit(1)).over(whole)).alias("_last"))
    totals = rows.groupBy("_chunk", "conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct("role"), "_place").alias("first"), F.max_by(F.struct("role"), "_place").alias("last"),
        F.max(F.when(F.col("role") == "user", F.col("_in"))).alias("user"))
    c = Window.partitionBy("conv_id").orderBy("_chunk")             # one row a chunk: scan_rows times fewer than messages
    every = c.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.sum("n").over(c) - F.col("n")
    carries = totals.select(
        F.col("_chunk").alias("_c"), F.col("conv_id").alias("_conv"), base.alias("_base"), F.lag("last").over(c).alias("_before"),
        F.lead("first").over(c).alias("_after"), F.first("first").over(every)["role"].alias("first_role"), (base + F.col("user")).alias("_user"))
    carries = carries.withColumn("last_user", F.coalesce(F.max("_user").over(Window.partitionBy("_conv")), F.lit(-1)))
    m = rows.join(carries, (F.col("_chunk") == F.col("_c")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
    return m.select(*msgs.columns, (F.col("_base") + F.col("_in")).alias("pos"),
                    F.when(F.col("_in") == 0, F.col("_before")["role"]).otherwise(F.col("_prev")).alias("prev_role"),
                    F.when(F.col("_last"), F.col("_after")["role"]).otherwise(F.col("_next")).alias("next_role"), "first_role", "last_user")


def _tool_call_blocks(tool_calls: Column, args_are_map: bool) -> Column:
    def one(tc):
        if args_are_map:
            entries = F.map_entries(F.coalesce(tc["arguments"], F.create_map().cast("map<string,string>")))
        else:
            entries = F.coalesce(tc["arguments"], F.array().cast("array<struct<key:string,value:string>>"))
        params = F.array_join(F.transform(
            entries,
            lambda e: F.concat(_lit("<parameter="), e["key"], _lit(">\n"), e["value"], _lit("\n</parameter>\n"))), "")
        return F.concat(_lit("<tool_call>\n<function="), tc["name"], _lit(">\n"), params,
                        _lit("</function>\n</tool_call>\n"))
    return F.array_join(F.transform(tool_calls, one), "")


def render_segments(msgs: DataFrame, truncate_history_thinking: bool = True) -> DataFrame:
    """conv_id, turn, pos, segment: the rendered text of every message in the loop
    (a leading system message is the header and yields no segment)."""
    return _segments(positions(msgs), truncate_history_thinking)


def _segments(m: DataFrame, truncate_history_thinking: bool) -> DataFrame:
    """Segments of messages with their positions."""
    if "reasoning" not in m.columns:
        m = m.withColumn("reasoning", F.lit(None).cast("string"))
    if "tool_calls" not in m.columns:
        m = m.withColumn("tool_calls", F.lit(None).cast(
            "array<struct<name:string,arguments:array<struct<key:string,value:string>>>>"))
    args_type = m.schema["tool_calls"].dataType.elementType["arguments"].dataType
    args_are_map = args_type.typeName() == "map"
    has_sys = F.col("first_role").eqNullSafe("system")
    in_loop = ~(has_sys & (F.col("pos") == 0))
    truncated = F.lit(truncate_history_thinking) & (F.col("pos") < F.col("last_user"))

    raw = F.coalesce(F.col("text"), _lit(""))
    reasoning_ok = F.col("reasoning").isNotNull() & (F.length(strip(F.col("reasoning"))) > 0)
    no_tags = ~raw.contains(THINK_OPEN) & ~raw.contains(THINK_CLOSE)
    content = (F.when(reasoning_ok, F.concat(_lit("<think>\n"), F.col("reasoning"), _lit("\n</think>\n"), raw))
               .when(no_tags, F.concat(_lit(EMPTY_THINK), raw)).otherwise(raw))
    after_close = F.element_at(F.split(content, THINK_CLOSE), -1)
    before_open = F.element_at(F.split(content, THINK_OPEN), 1)

    # assistant with tool calls
    hist = F.when(content.contains(THINK_CLOSE), after_close).when(content.contains(THINK_OPEN), before_open) \
        .otherwise(content)
    tc_content = F.when(F.length(strip(content)) > 0,
                        F.when(~truncated, F.concat(strip(content), _lit("\n")))
                        .otherwise(F.concat(_lit(EMPTY_THINK), strip(hist), _lit("\n")))) \
        .otherwise(_lit(EMPTY_THINK))
    with_tools = F.concat(_lit(IM_START + "assistant\n"), tc_content,
                          _tool_call_blocks(F.col("tool_calls"), args_are_map), _lit(IM_END))
    # assistant without tool calls
    trunc_c = strip(F.when(content.contains(THINK_OPEN) & content.contains(THINK_CLOSE),
                           F.concat(_lit(EMPTY_THINK), after_close)).otherwise(content))
    plain = F.concat(_lit(IM_START + "assistant\n"), F.when(truncated, trunc_c).otherwise(strip(content)), _lit(IM_END))
    has_calls = F.col("tool_calls").isNotNull() & (F.size(F.col("tool_calls")) > 0)
    assistant = F.when(has_calls, with_tools).otherwise(plain)
    # tool responses: a block opens after a non-tool message, closes before one
    prev_in_loop = F.col("pos") > F.when(has_sys, 1).otherwise(0)
    opens = F.when(prev_in_loop & ~F.col("prev_role").eqNullSafe("tool"), _lit(IM_START + "user\n")).otherwise(_lit(""))
    closes = F.when(~F.col("next_role").eqNullSafe("tool"), _lit(IM_END)).otherwise(_lit(""))
    tool = F.concat(opens, _lit(TOOL_RESPONSE_OPEN), raw, _lit(TOOL_RESPONSE_CLOSE), closes)
    other = F.concat(_lit(IM_START), F.coalesce("role", _lit("")), _lit("\n"), raw, _lit(IM_END))

    role = F.col("role")
    seg = (F.when(role == "assistant", assistant).when(role == "tool", tool).otherwise(other))
    return m.where(in_loop).select("conv_id", "turn", "pos", seg.alias("segment"))


def system_headers(msgs: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """conv_id, header: the system block every conversation starts with."""
    return _headers(positions(msgs), tools)


def _headers(m: DataFrame, tools: DataFrame | None) -> DataFrame:
    sysmsg = F.when(F.col("role") == "system", F.coalesce(F.col("text"), _lit(""))).otherwise(_lit(""))
    h = m.where(F.col("pos") == 0).select("conv_id", sysmsg.alias("system_message"))
    if tools is not None:
        as_json = tools.schema["tools"].dataType.typeName() == "string"
        given = (tools_preamble_json if as_json else tools_preamble)(tools).withColumnRenamed("conv_id", "_conv")
        h = h.join(given, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        pre = F.when(F.col("preamble").isNotNull(),
                     F.concat(F.when(F.length("system_message") > 0, _lit("\n\n")).otherwise(_lit("")),
                              F.col("preamble"))).otherwise(_lit(""))
    else:
        pre = _lit("")
    return h.select("conv_id", F.concat(_lit(IM_START + "system\n"), F.col("system_message"), pre,
                                        _lit(IM_END)).alias("header"))


def json_string_list(arr: Column) -> Column:
    """A string array as JSON text with ``", "`` separators (the template's
    ``tojson`` is Python's ``json.dumps`` with default separators)."""
    quoted = F.transform(arr, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def tools_preamble(tools: DataFrame) -> DataFrame:
    """conv_id, preamble from ``tools(conv_id, tools ARRAY<STRUCT<name,
    description, parameters ARRAY<STRUCT<name, type, description, enum
    ARRAY<STRING>>>, required ARRAY<STRING>>>)``. Tools may also be wrapped, as
    ``STRUCT<type, function STRUCT<...>>``. Any further field of a parameter or a
    tool is an extra key: printed after the known ones where it is not null,
    lists and maps as JSON.
    """
    kind = tools.schema["tools"].dataType.elementType
    if "function" in kind.names:
        tools = tools.withColumn("tools", F.transform("tools", lambda t: t["function"]))
        kind = kind["function"].dataType
    p_kind = kind["parameters"].dataType.elementType

    def extras(value, of, known):
        out = []
        for f in of.fields:
            if f.name not in known:
                v = value[f.name]
                nested = f.dataType.typeName() in ("array", "map", "struct")
                shown = json_string_list(v) if f.dataType.simpleString() == "array<string>" else F.to_json(v) if nested else v.cast("string")
                out.append(F.when(v.isNotNull(), F.concat(_lit(f"\n<{f.name}>"), shown, _lit(f"</{f.name}>"))).otherwise(_lit("")))
        return F.concat(*out) if out else _lit("")

    def param(p):
        return F.concat(
            _lit("\n<parameter>\n<name>"), p["name"], _lit("</name>"),
            F.when(p["type"].isNotNull(), F.concat(_lit("\n<type>"), p["type"], _lit("</type>"))).otherwise(_lit("")),
            F.when(p["description"].isNotNull(),
                   F.concat(_lit("\n<description>"), strip(p["description"]), _lit("</description>"))).otherwise(_lit("")),
            F.when(p["enum"].isNotNull(), F.concat(_lit("\n<enum>"), json_string_list(p["enum"]), _lit("</enum>"))).otherwise(_lit("")),
            extras(p, p_kind, ("name", "type", "description", "enum")),
            _lit("\n</parameter>"))

    def fn(t):
        return F.concat(
            _lit("\n<function>\n<name>"), t["name"], _lit("</name>"),
            F.when(t["description"].isNotNull(),
                   F.concat(_lit("\n<description>"), strip(t["description"]), _lit("</description>"))).otherwise(_lit("")),
            _lit("\n<parameters>"),
            F.array_join(F.transform(F.coalesce(t["parameters"], F.array()), param), ""),
            F.when(t["required"].isNotNull(),
                   F.concat(_lit("\n<required>"), json_string_list(t["required"]), _lit("</required>"))).otherwise(_lit("")),
            _lit("\n</parameters>"), extras(t, kind, ("type", "name", "description", "parameters", "required")), _lit("\n</function>"))

    body = F.array_join(F.transform(F.col("tools"), fn), "")
    return tools.where(F.size("tools") > 0).select(
        "conv_id", F.concat(_lit(TOOLS_HEADER), body, _lit(TOOLS_FOOTER), _lit(TOOLS_INSTRUCTIONS)).alias("preamble"))


def tools_preamble_json(tools: DataFrame) -> DataFrame:
    """conv_id, preamble from ``tools(conv_id, tools STRING)``, a JSON array of tools as they are sent to a model: each an object with
    name, description and parameters (a JSON schema), or wrapped as ``{"type": ..., "function": {...}}``. Keys keep their order;
    keys beyond the known ones of a parameter, of ``parameters`` and of the tool are printed where the template prints them.
    A text that is no array, or an empty one, gives no row."""
    def tag(name, shown):
        return F.concat(_lit("\n<"), name, _lit(">"), shown, _lit("</"), name, _lit(">"))

    def if_there(obj, key, shown):
        return F.when(js.has(obj, key), tag(_lit(key), shown)).otherwise(_lit(""))

    def value(obj, key):
        return js.printed(js.raw(obj, key), js.kind(obj, key))

    def extras(obj, known):
        rest = F.filter(js.keys(obj), lambda k: ~k.isin(*known))
        return F.array_join(F.transform(rest, lambda k: tag(k, value(obj, k))), "")

    def param(name, p):
        return F.concat(
            _lit("\n<parameter>"), tag(_lit("name"), name), if_there(p, "type", js.printed_list(js.raw(p, "type"), js.kind(p, "type"))),
            if_there(p, "description", strip(value(p, "description"))), if_there(p, "enum", js.spaced(js.raw(p, "enum"))),
            extras(p, ("name", "type", "description", "enum")), _lit("\n</parameter>"))

    def fn(tool):
        t = F.when(js.has(tool, "function"), js.raw(tool, "function")).otherwise(tool)
        spec = js.raw(t, "parameters")
        props = js.raw(spec, "properties")
        return F.concat(
            _lit("\n<function>"), tag(_lit("name"), F.coalesce(js.raw(t, "name"), _lit(""))), if_there(t, "description", strip(value(t, "description"))),
            _lit("\n<parameters>"), F.array_join(F.transform(js.keys(props), lambda k: param(k, js.raw(props, k))), ""),
            extras(spec, ("type", "properties", "required")), if_there(spec, "required", js.spaced(js.raw(spec, "required"))),
            _lit("\n</parameters>"), extras(t, ("type", "name", "description", "parameters")), _lit("\n</function>"))

    given = tools.select("conv_id", js.elements(F.col("tools")).alias("tools")).where(F.size("tools") > 0)
    body = F.array_join(F.transform("tools", fn), "")
    return given.select("conv_id", F.concat(_lit(TOOLS_HEADER), body, _lit(TOOLS_FOOTER), _lit(TOOLS_INSTRUCTIONS)).alias("preamble"))


def tool_calls_of_json(calls: Column) -> Column:
    """``tool_calls`` for the renderer from a JSON array of ``{"name": ..., "arguments": {...}}``, wrapped as ``{"function": ...}`` or not:
    arguments in written order, lists and objects as JSON."""
    def one(c):
        f = F.when(js.has(c, "function"), js.raw(c, "function")).otherwise(c)
        given = js.raw(f, "arguments")
        return F.struct(F.coalesce(js.raw(f, "name"), _lit("")).alias("name"), F.transform(js.keys(given), lambda k: F.struct(
            k.alias("key"), js.printed(js.raw(given, k), js.kind(given, k)).alias("value"))).alias("arguments"))

    return F.transform(js.elements(calls), one)


def render(msgs: DataFrame, truncate_history_thinking: bool = True, add_generation_prompt: bool = False,
           enable_thinking: bool = True, tools: DataFrame | None = None) -> DataFrame:
    """conv_id, text: the whole rendered conversation."""
    m = positions(msgs)
    segs = _segments(m, truncate_history_thinking)

    def ordered_concat(key, col):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, col))), lambda x: x[col]), "")

    # two levels: chunks of CHUNK_TURNS turns, then the chunks of a conversation
    chunks = (segs.withColumn("chunk", F.floor(F.col("pos") / CHUNK_TURNS))
              .groupBy("conv_id", "chunk").agg(ordered_concat("pos", "segment").alias("part")))
    body = chunks.groupBy(F.col("conv_id").alias("_body")).agg(ordered_concat("chunk", "part").alias("body"))
    gen = (GEN_PROMPT_THINKING if enable_thinking else GEN_PROMPT_NO_THINKING) if add_generation_prompt else ""
    return (_headers(m, tools).join(body, F.col("conv_id").eqNullSafe(F.col("_body")), "left")
            .select("conv_id", F.concat("header", F.coalesce("body", _lit("")), _lit(gen)).alias("text")))
