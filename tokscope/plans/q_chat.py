"""Chat rendering queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokscope.operators import chat
from tokscope.plans.catalog import register
from tokscope.plans.oracle import ORACLE, STRIP, q
from tokscope.sources import corpus


def _msgs(spark, sf_dir):
    return corpus.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


@register("chat_render")
def q_chat_render(spark, sf_dir):
    """One training text per conversation (history thinking truncated)."""
    return chat.render(_msgs(spark, sf_dir))


@register("chat_render_prompt")
def q_chat_render_prompt(spark, sf_dir):
    """No truncation, generation prompt appended with thinking switched off."""
    return chat.render(_msgs(spark, sf_dir), truncate_history_thinking=False,
                       add_generation_prompt=True, enable_thinking=False)


@register("chat_segments")
def q_chat_segments(spark, sf_dir):
    """Per-message rendered segments (the distributed form of the render)."""
    return chat.render_segments(_msgs(spark, sf_dir)).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "segment")


def _st(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP)}, '', 'g')"


#: The given conversations have neither thoughts nor tools. This view adds them by rule: turn numbers get gaps, some user turns
#: become tool results (runs of them too), and assistants think in whole or broken tags and call a tool.
_PLAIN = "SELECT conv_id, turn, role, coalesce(text, '') AS raw, '' AS call FROM conversations"
_DERIVED = """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn,
  CASE WHEN role = 'user' AND (conv_id + turn) % 5 > 2 THEN 'tool' ELSE role END AS role,
  CASE WHEN role <> 'assistant' THEN coalesce(text, '') WHEN conv_id % 4 = 0 THEN '<think>why</think> ' || coalesce(text, '') || ' '
       WHEN conv_id % 4 = 1 THEN coalesce(text, '') || '</think> so' WHEN conv_id % 4 = 2 THEN 'x<think>' || coalesce(text, '')
       ELSE coalesce(text, '') END AS raw,
  CASE WHEN role = 'assistant' AND (conv_id + turn) % 3 = 0 THEN CAST(turn AS VARCHAR) ELSE '' END AS call FROM conversations"""


def _derived(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    k, assistant, t = F.col("conv_id") + F.col("turn"), F.col("role") == "assistant", F.coalesce("text", F.lit(""))
    by = F.col("conv_id") % 4
    thought = (F.when(by == 0, F.concat(F.lit("<think>why</think> "), t, F.lit(" "))).when(by == 1, F.concat(t, F.lit("</think> so")))
               .when(by == 2, F.concat(F.lit("x<think>"), t)).otherwise(t))
    call = F.array(F.struct(F.lit("f").alias("name"), F.array(F.struct(F.lit("k").alias("key"), F.col("turn").cast("string").alias("value"))).alias("arguments")))
    return m.select("conv_id", (F.col("turn") * 2 + 3).alias("turn"), F.when((F.col("role") == "user") & (k % 5 > 2), "tool").otherwise(F.col("role")).alias("role"),
                    F.when(assistant, thought).otherwise(t).alias("text"), F.when(assistant & (k % 3 == 0), call).alias("tool_calls"))


@register("chat_render_tools")
def q_chat_render_tools(spark, sf_dir):
    """Thoughts (whole and broken), tool calls, tool results and gaps between turn numbers; history thinking truncated."""
    return chat.render(_derived(spark, sf_dir))


@register("chat_render_tools_prompt")
def q_chat_render_tools_prompt(spark, sf_dir):
    """The same view with all thinking kept and a generation prompt that thinks."""
    return chat.render(_derived(spark, sf_dir), truncate_history_thinking=False, add_generation_prompt=True, enable_thinking=True)


#: As an exported log may have them: two messages a turn number, and some messages without one.
_LOG = """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY t NULLS FIRST, role, raw) - 1 AS turn, role, raw, '' AS call
  FROM (SELECT conv_id, CASE WHEN (conv_id + turn) % 7 = 3 THEN NULL ELSE turn // 2 END AS t,
          CASE WHEN role = 'user' AND (conv_id + turn) % 5 > 2 THEN 'tool' ELSE role END AS role, coalesce(text, '') AS raw FROM conversations)"""


def _log(spark, sf_dir):
    m = _msgs(spark, sf_dir)
    k = F.col("conv_id") + F.col("turn")
    return m.select("conv_id", F.when(k % 7 != 3, F.expr("turn div 2")).alias("turn"),
                    F.when((F.col("role") == "user") & (k % 5 > 2), "tool").otherwise(F.col("role")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


@register("chat_render_log")
def q_chat_render_log(spark, sf_dir):
    """Conversations whose turn numbers repeat or are missing: messages stand in the order of turn, role and text."""
    return chat.render(_log(spark, sf_dir))


_TOOLS = ('[{"type":"function","function":{"name":"find","description":" Finds §  ","strict":true,"parameters":{"type":"object","properties":{'
          '"q":{"type":["string","null"],"description":"text, § \\"words\\"","default":null,"examples":["a, b",{"z":§,"a":[1.5,false]}]},'
          '"n":{"type":"integer","enum":[1,2,§],"minimum":§}},"required":["q"],"additionalProperties":false,"order":{"z":1,"a":{}}}}},'
          '{"name":"noop","tags":["x","y:z"]}]')
_TOOLS_TEXT = ("\n<function>\n<name>find</name>\n<description>Finds §</description>\n<parameters>\n<parameter>\n<name>q</name>\n<type>['string', 'null']</type>"
               '\n<description>text, § "words"</description>\n<default>None</default>\n<examples>["a, b", {"z": §, "a": [1.5, false]}]</examples>\n</parameter>'
               "\n<parameter>\n<name>n</name>\n<type>integer</type>\n<enum>[1, 2, §]</enum>\n<minimum>§</minimum>\n</parameter>"
               '\n<additionalProperties>False</additionalProperties>\n<order>{"z": 1, "a": {}}</order>\n<required>["q"]</required>\n</parameters>\n<strict>True</strict>\n</function>'
               '\n<function>\n<name>noop</name>\n<parameters>\n</parameters>\n<tags>["x", "y:z"]</tags>\n</function>')


@register("chat_render_json_tools")
def q_chat_render_json_tools(spark, sf_dir):
    """Conversations with tools given as JSON, nested and with keys in their own order (every third conversation has none)."""
    m = _msgs(spark, sf_dir)
    text = F.replace(F.lit(_TOOLS), F.lit("§"), F.col("conv_id").cast("string"))
    tools = m.select("conv_id").distinct().withColumn("tools", F.when(F.col("conv_id") % 3 != 0, text).otherwise("[]"))
    return chat.render(m, tools=tools)


def _segments_sql(truncate: bool, source: str = _PLAIN) -> str:
    S, E = q(chat.IM_START), q(chat.IM_END)
    A = q(chat.IM_START + "assistant\n")
    ET = q(chat.EMPTY_THINK)
    trunc = "(idx < lui)" if truncate else "false"
    after = "string_split(content, '</think>')[-1]"
    trunc_c = _st(f"CASE WHEN contains(content, '<think>') AND contains(content, '</think>') THEN {ET} || {after} ELSE content END")
    hist = f"CASE WHEN contains(content, '</think>') THEN {after} WHEN contains(content, '<think>') THEN string_split(content, '<think>')[1] ELSE content END"
    block = ("'<tool_call>' || chr(10) || '<function=f>' || chr(10) || '<parameter=k>' || chr(10) || call || chr(10) || '</parameter>' || chr(10) "
             "|| '</function>' || chr(10) || '</tool_call>' || chr(10)")
    return f"""
m AS ({source}),
f AS (SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(raw, turn) AS first_text,
             coalesce(max(CASE WHEN role = 'user' THEN turn END), -1) AS last_user_turn, max(turn) AS last_turn
      FROM m GROUP BY conv_id),
x AS (SELECT m.*, f.first_role, f.last_user_turn, f.last_turn,
             lag(role) OVER (PARTITION BY m.conv_id ORDER BY turn) AS prev_role,
             lead(role) OVER (PARTITION BY m.conv_id ORDER BY turn) AS next_role
      FROM m JOIN f USING (conv_id)),
y AS (SELECT *, turn - (CASE WHEN first_role = 'system' THEN 1 ELSE 0 END) AS idx,
             CASE WHEN last_user_turn < 0 THEN -1 ELSE last_user_turn - (CASE WHEN first_role = 'system' THEN 1 ELSE 0 END) END AS lui,
             CASE WHEN NOT contains(raw, '<think>') AND NOT contains(raw, '</think>') THEN {ET} || raw ELSE raw END AS content
      FROM x),
s AS (SELECT conv_id, turn, CASE
        WHEN role = 'assistant' AND call <> '' THEN {A} || (CASE WHEN length({_st('content')}) = 0 THEN {ET}
             WHEN {trunc} THEN {ET} || {_st(hist)} || chr(10) ELSE {_st('content')} || chr(10) END) || {block} || {E}
        WHEN role = 'assistant' THEN {A} || (CASE WHEN {trunc} THEN {trunc_c} ELSE {_st('content')} END) || {E}
        WHEN role = 'tool' THEN (CASE WHEN prev_role IS NOT NULL AND idx > 0 AND prev_role <> 'tool' THEN {S} || 'user' || chr(10) ELSE '' END)
             || {q(chat.TOOL_RESPONSE_OPEN)} || raw || {q(chat.TOOL_RESPONSE_CLOSE)}
             || (CASE WHEN turn = last_turn OR next_role <> 'tool' THEN {E} ELSE '' END)
        ELSE {S} || role || chr(10) || raw || {E} END AS segment
      FROM y WHERE NOT (first_role = 'system' AND turn = 0))"""


def _render_sql(truncate: bool, gen: str, source: str = _PLAIN) -> str:
    return f"""WITH {_segments_sql(truncate, source)}
SELECT f.conv_id, {q(chat.IM_START + 'system' + chr(10))} || (CASE WHEN f.first_role = 'system' THEN f.first_text ELSE '' END)
       || {q(chat.IM_END)} || coalesce((SELECT string_agg(segment, '' ORDER BY turn) FROM s WHERE s.conv_id = f.conv_id), '')
       || {q(gen)} AS text
FROM f"""


ORACLE["chat_render"] = _render_sql(True, "")
ORACLE["chat_render_prompt"] = _render_sql(False, chat.GEN_PROMPT_NO_THINKING)
ORACLE["chat_render_tools"] = _render_sql(True, "", _DERIVED)
ORACLE["chat_render_tools_prompt"] = _render_sql(False, chat.GEN_PROMPT_THINKING, _DERIVED)
_JSON_HEAD = f"""CASE WHEN f.conv_id % 3 = 0 THEN '' ELSE (CASE WHEN f.first_role = 'system' AND length(f.first_text) > 0 THEN chr(10) || chr(10) ELSE '' END)
  || {q(chat.TOOLS_HEADER)} || replace({q(_TOOLS_TEXT)}, '§', CAST(f.conv_id AS VARCHAR)) || {q(chat.TOOLS_FOOTER + chat.TOOLS_INSTRUCTIONS)} END"""
ORACLE["chat_render_json_tools"] = _render_sql(True, "").replace(f"|| {q(chat.IM_END)} || coalesce((", f"|| {_JSON_HEAD} || {q(chat.IM_END)} || coalesce((", 1)
ORACLE["chat_render_log"] = _render_sql(True, "", _LOG)
ORACLE["chat_segments"] = f"WITH {_segments_sql(True)}\nSELECT conv_id, CAST(turn AS BIGINT) AS turn, segment FROM s"
