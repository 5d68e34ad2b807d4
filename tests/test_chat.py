from pyspark.sql import functions as F

from reference_impl import render_chat
from tokscope.operators import chat

SCHEMA = ("conv_id long, turn long, role string, text string, reasoning string, "
          "tool_calls array<struct<name:string,arguments:array<struct<key:string,value:string>>>>")

CONVS = {
    1: [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "<think>a</think>b"},
        {"role": "user", "content": "again"}, {"role": "assistant", "content": "<think>c</think> d "}],
    2: [{"role": "system", "content": "sys"}, {"role": "tool", "content": "r0"},
        {"role": "user", "content": "q"},
        {"role": "assistant", "content": "x", "tool_calls": [{"name": "f", "arguments": {"k": "1", "m": "{\"a\": 2}"}}]},
        {"role": "tool", "content": "r1"}, {"role": "tool", "content": "r2"},
        {"role": "assistant", "content": "<think>open only"}, {"role": "user", "content": "end"}],
    3: [{"role": "assistant", "content": "plain", "reasoning_content": "why"},
        {"role": "assistant", "content": "  ", "reasoning_content": "  "},
        {"role": "assistant", "content": "", "tool_calls": [{"name": "g", "arguments": {}}]}],
    4: [{"role": "user", "content": "u"}, {"role": "assistant", "content": "t <think>x", "tool_calls": [{"name": "h", "arguments": {"z": "v"}}]},
        {"role": "user", "content": "u2"}, {"role": "system", "content": "mid"}],
}


def _df(spark):
    rows = []
    for cid, msgs in CONVS.items():
        for t, m in enumerate(msgs):
            tc = [(c["name"], list(c["arguments"].items())) for c in m.get("tool_calls", [])] or None
            rows.append((cid, t, m["role"], m["content"], m.get("reasoning_content"), tc))
    return spark.createDataFrame(rows, SCHEMA)


def _check(spark, **kw):
    got = {r["conv_id"]: r["text"] for r in chat.render(_df(spark), **kw).collect()}
    for cid, msgs in CONVS.items():
        assert got[cid] == render_chat(msgs, **kw), (cid, kw)


def test_render_default(spark):
    _check(spark)


def test_render_no_truncation_with_prompt(spark):
    _check(spark, truncate_history_thinking=False, add_generation_prompt=True, enable_thinking=True)
    _check(spark, truncate_history_thinking=True, add_generation_prompt=True, enable_thinking=False)


TOOLS = [{"name": "get_weather", "description": " Weather now ",
          "parameters": {"properties": {"city": {"type": "string", "description": "City \"name\"", "enum": ["Pune", "Kochi"]},
                                        "days": {"type": "integer"}},
                         "required": ["city"]}},
         {"name": "noop", "parameters": {"properties": {}}}]
TOOLS_SCHEMA = ("conv_id long, tools array<struct<name:string,description:string,parameters:array<struct<"
                "name:string,type:string,description:string,enum:array<string>>>,required:array<string>>>")


def test_tools_preamble(spark):
    rows = []
    for t in TOOLS:
        params = [(k, v.get("type"), v.get("description"), v.get("enum"))
                  for k, v in t["parameters"]["properties"].items()]
        rows.append((t["name"], t.get("description"), params, t["parameters"].get("required")))
    tools = spark.createDataFrame([(1, rows), (3, rows)], TOOLS_SCHEMA)
    got = {r["conv_id"]: r["text"] for r in chat.render(_df(spark), tools=tools).collect()}
    for cid in (1, 3):
        assert got[cid] == render_chat(CONVS[cid], tools=TOOLS), cid
    assert got[2] == render_chat(CONVS[2])


def test_long_conversation_chunked_concat(spark):
    msgs = [{"role": "user" if i % 2 == 0 else "assistant", "content": f"m{i} <think>r</think>x" if i % 7 == 3 else f"m{i}"}
            for i in range(601)]
    rows = [(9, t, m["role"], m["content"], None, None) for t, m in enumerate(msgs)]
    got = chat.render(spark.createDataFrame(rows, SCHEMA)).first()["text"]
    assert got == render_chat(msgs)


def test_turn_numbers_may_have_gaps(spark):
    """Neighbours are found by position, so turns 0, 2, 4, ... render like 0, 1, 2, ..."""
    df = _df(spark)
    gaps = df.withColumn("turn", df.turn * 2 + 3)
    for kw in ({}, {"truncate_history_thinking": False}):
        got = {r.conv_id: r.text for r in chat.render(gaps, **kw).collect()}
        assert got == {r.conv_id: r.text for r in chat.render(df, **kw).collect()}
        assert got == {cid: render_chat(msgs, **kw) for cid, msgs in CONVS.items()}


def test_wrapped_tools_and_extra_keys(spark):
    plain = {"name": "find", "description": "Finds", "strict": "yes",
             "parameters": {"properties": {"q": {"type": "string", "default": "all", "examples": ["a", "b"]}, "n": {"type": "integer"}}}}
    params = [("q", "string", None, None, "all", ["a", "b"]), ("n", "integer", None, None, None, None)]
    schema = ("conv_id long, tools array<struct<type:string,function:struct<name:string,description:string,parameters:array<struct<name:string,"
              "type:string,description:string,enum:array<string>,default:string,examples:array<string>>>,required:array<string>,strict:string>>>")
    tools = spark.createDataFrame([(1, [("function", ("find", "Finds", params, None, "yes"))])], schema)
    got = {r.conv_id: r.text for r in chat.render(_df(spark), tools=tools).collect()}
    assert got[1] == render_chat(CONVS[1], tools=[{"type": "function", "function": plain}])


def test_repeated_and_missing_turn_numbers(spark):
    """Every message once, in the order of turn (none first), role and text; a conversation without id is one too."""
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, "system", "sys"), (1, 2, "assistant", "c"), (1, 2, "assistant", "c"), (1, 3, "tool", "r"),
            (1, 3, "tool", "s"), (None, 0, "user", "lost"), (None, None, "tool", "first"), (2, None, None, None), (2, None, "user", "x"), (2, 0, "tool", None)]
    got = {r.conv_id: r.text for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()}
    assert set(got) == {1, 2, None}
    msgs = [("system", "sys"), ("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "c"), ("tool", "r"), ("tool", "s")]
    assert got[1] == render_chat([{"role": r, "content": t} for r, t in msgs])
    assert got[None] == render_chat([{"role": "tool", "content": "first"}, {"role": "user", "content": "lost"}])
    assert got[2] == render_chat([{"role": "", "content": ""}, {"role": "user", "content": "x"}, {"role": "tool", "content": ""}])


def test_scan_in_segments_equals_one_window(spark):
    """Chunks of three messages: totals and carries give what a window over the whole conversation gives."""
    import random
    rnd = random.Random(4)
    rows = [(c, rnd.choice([None, *range(20)]), rnd.choice(["user", "tool", "assistant", "system"]), rnd.choice(["x", "y", None]))
            for c in (1, 2, 3) for _ in range(rnd.randint(20, 40))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = sorted(map(tuple, chat.positions(df, scan_rows=3).collect()), key=lambda r: (r[0], r[4]))
    for c in (1, 2, 3):
        mine = [r for r in got if r[0] == c]
        want = sorted([r for r in rows if r[0] == c], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] is not None, r[3] or ""))
        assert [r[:4] for r in mine] == want and [r[4] for r in mine] == list(range(len(want)))
        roles = [r[2] for r in want]
        assert [r[5] for r in mine] == [None, *roles[:-1]] and [r[6] for r in mine] == [*roles[1:], None]
        assert {r[7] for r in mine} == {roles[0]} and {r[8] for r in mine} == {max((i for i, x in enumerate(roles) if x == "user"), default=-1)}


def test_tools_and_calls_as_json(spark):
    """Nested values, numbers, booleans and nulls in written order; calls with JSON arguments; texts that are no tools."""
    import json
    spec = {"type": "object", "properties": {"b": {"type": "string", "enum": ["x, y", "k: v", "say \\ \"hi\""], "default": True, "pattern": "^a:b,c$"},
                                             "a": {"items": {"z": [1, {"y": None}], "a": 2.5}, "maxItems": 3, "nullable": None}}, "required": ["b", "a"]}
    plain = [{"name": "one", "description": "  d  ", "parameters": spec}, {"type": "function", "function": {"name": "two", "parameters": {"properties": {}}}}]
    rows = [(1, json.dumps(plain)), (2, "[]"), (3, json.dumps(plain, separators=(",", ":")))]
    tools = spark.createDataFrame(rows, "conv_id long, tools string")
    got = {r.conv_id: r.preamble for r in chat.tools_preamble_json(tools).collect()}
    assert set(got) == {1, 3} and got[1] == got[3]
    for part in ('<name>b</name>\n<type>string</type>\n<enum>["x, y", "k: v", "say \\\\ \\"hi\\""]</enum>\n<default>True</default>\n<pattern>^a:b,c$</pattern>',
                 '<name>a</name>\n<items>{"z": [1, {"y": null}], "a": 2.5}</items>\n<maxItems>3</maxItems>\n<nullable>None</nullable>',
                 '<required>["b", "a"]</required>', "<name>two</name>\n<parameters>\n</parameters>"):
        assert part in got[1], part
    text = {r.conv_id: r.text for r in chat.render(_df(spark), tools=tools).collect()}
    assert got[1] in text[1] and text[2] == render_chat(CONVS[2])
    bad = spark.createDataFrame([(1, None), (2, "no json"), (3, "{}")], "conv_id long, tools string")
    assert chat.tools_preamble_json(bad).count() == 0
    calls = [{"function": {"name": "f", "arguments": {"k": "v", "m": {"z": 1, "a": [True, "x,y"]}, "n": 3, "t": False}}}, {"name": "g"}]
    df = spark.createDataFrame([(json.dumps(calls),)], "c string").select(chat.tool_calls_of_json(F.col("c")).alias("c"))
    c = df.first().c
    assert [(x.name, [(a.key, a.value) for a in x.arguments]) for x in c] == [
        ("f", [("k", "v"), ("m", '{"z": 1, "a": [true, "x,y"]}'), ("n", "3"), ("t", "False")]), ("g", [])]
