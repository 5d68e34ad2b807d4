"""Plain-Python checkers written from the documented semantics (no Spark).

Used by the tests as brute-force oracles for the operators whose results
are not SQL-expressible (iterative BPE, encode, chat rendering) and to pin
the Unicode rules of strip/split/pre-tokenization to Python's own.
"""

from __future__ import annotations

import json
from itertools import groupby

import regex

from tokscope.operators.chat import TOOLS_INSTRUCTIONS

# Code-point ranges of the script blocks, in the order of the alternation
_RANGES = [r"\u0900-\u097F\u1CD0-\u1CFF\uA8E0-\uA8FF", r"\u0980-\u09FF", r"\u0A00-\u0A7F", r"\u0A80-\u0AFF",
           r"\u0B00-\u0B7F", r"\u0B80-\u0BFF", r"\u0C00-\u0C7F", r"\u0C80-\u0CFF", r"\u0D00-\u0D7F", r"\u1C50-\u1C7F",
           r"\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF", "a-zA-Z"]
# First match wins, then numbers, white space (dropped) and any single character
PRETOK = regex.compile("|".join([f"[{r}]+" for r in _RANGES] + [r"[0-9]+(?:[.,][0-9]+)*", r"\s+", "."]), regex.DOTALL)


def pretokenize(text: str) -> list[str]:
    return [m.group() for m in PRETOK.finditer(text) if m.group().strip()]


def pretokenize_spans(text: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in PRETOK.finditer(text) if m.group().strip()]


def model_split(text: str) -> list[str]:
    return regex.findall(r"[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}\s]+", text)


def bpe_train_sequential(words: dict[str, int], n_merges: int, min_frequency: int = 1):
    """One merge at a time: count adjacent pairs weighted by frequency, take
    the max count (ties: smallest (left, right)), merge left to right."""
    segs = {w: list(w) for w in words}
    merges = []
    for _ in range(n_merges):
        counts: dict[tuple[str, str], int] = {}
        for w, f in words.items():
            s = segs[w]
            for a, b in zip(s, s[1:]):
                counts[(a, b)] = counts.get((a, b), 0) + f
        if not counts:
            break
        best = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        if best[1] < min_frequency:
            break
        (a, b), c = best
        merges.append((a, b, c))
        for w in words:
            s, out, i = segs[w], [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            segs[w] = out
    return merges, segs


OPEN, CLOSE, NO_THOUGHT = "<think>", "</think>", "<think></think>"


def _said(role: str, body: str) -> str:
    return f"<|im_start|>{role}\n{body}<|im_end|>\n"


def _thoughts_and_answer(m: dict) -> str:
    """An assistant's content with its reasoning in front, or with an empty thought if it has none at all."""
    text, why = m.get("content") or "", m.get("reasoning_content") or ""
    if why.strip():
        return f"{OPEN}\n{why}\n{CLOSE}\n{text}"
    return text if OPEN in text or CLOSE in text else NO_THOUGHT + text


def _calls(m: dict) -> str:
    def one(call):
        given = "".join(f"<parameter={k}>\n{v}\n</parameter>\n" for k, v in call.get("arguments", {}).items())
        return f"<tool_call>\n<function={call['name']}>\n{given}</function>\n</tool_call>\n"
    return "".join(map(one, m.get("tool_calls") or []))


def _assistant(m: dict, old: bool) -> str:
    """``old``: before the last user message, so thoughts are cut."""
    full, calls = _thoughts_and_answer(m), _calls(m)
    has_open, has_close = OPEN in full, CLOSE in full
    if not calls:
        if old and has_open and has_close:
            full = NO_THOUGHT + full.rpartition(CLOSE)[2]
        return _said("assistant", full.strip())
    if not full.strip():
        return _said("assistant", NO_THOUGHT + calls)
    if old:
        answer = full.rpartition(CLOSE)[2] if has_close else full.partition(OPEN)[0] if has_open else full
        return _said("assistant", f"{NO_THOUGHT}{answer.strip()}\n{calls}")
    return _said("assistant", f"{full.strip()}\n{calls}")


def _tool_run(run: list[dict], leads: bool) -> str:
    """Neighbouring tool results are one user turn; a run that begins the conversation lacks the turn's opening."""
    body = "".join(f"<tool_response>\n{m['content']}\n</tool_response>\n" for m in run)
    turn = _said("user", body)
    return turn.removeprefix("<|im_start|>user\n") if leads else turn


def _tool_list(tools: list) -> str:
    def tag(name, value):
        return f"\n<{name}>{value}</{name}>"

    def fields(d, *, listed=()):
        return "".join(tag(k, json.dumps(d[k], ensure_ascii=False) if k in listed else str(d[k]).strip())
                       for k in ("type", "description", *listed) if k in d)

    out = ""
    for t in tools:
        t = t.get("function", t)
        spec = t.get("parameters", {})
        params = "".join(
            f"\n<parameter>{tag('name', k)}{fields(v, listed=('enum',))}"
            + "".join(tag(x, y if isinstance(y, str) else json.dumps(y)) for x, y in v.items() if x not in ("type", "description", "enum"))
            + "\n</parameter>" for k, v in spec.get("properties", {}).items())
        needs = tag("required", json.dumps(spec["required"], ensure_ascii=False)) if "required" in spec else ""
        about = {k: v for k, v in t.items() if k == "description"}
        more = "".join(tag(k, v) for k, v in t.items() if k not in ("type", "name", "description", "parameters"))
        out += f"\n<function>{tag('name', t['name'])}{fields(about)}\n<parameters>{params}{needs}\n</parameters>{more}\n</function>"
    return f"# Tools\n\nYou have access to the following functions:\n\n<tools>{out}\n</tools>{TOOLS_INSTRUCTIONS}"


def render_chat(messages: list[dict], tools: list | None = None, truncate_history_thinking: bool = True,
                add_generation_prompt: bool = False, enable_thinking: bool = True) -> str:
    """A conversation as training text: the system block, then every turn."""
    leading = [m["content"] for m in messages[:1] if m["role"] == "system"]
    turns = list(enumerate(messages[len(leading):]))
    asked = max((i for i, m in turns if m["role"] == "user"), default=-1)
    blocks = [x for x in leading if x] + ([_tool_list(tools)] if tools else [])
    out = _said("system", "\n\n".join(blocks))
    for is_tool, run in groupby(turns, key=lambda x: x[1]["role"] == "tool"):
        run = list(run)
        if is_tool:
            out += _tool_run([m for _, m in run], leads=run[0][0] == 0)
            continue
        for i, m in run:
            out += _assistant(m, truncate_history_thinking and i < asked) if m["role"] == "assistant" else _said(m["role"], m["content"])
    if not add_generation_prompt:
        return out
    return out + "<|im_start|>assistant\n" + (f"{OPEN}\n" if enable_thinking else NO_THOUGHT)
