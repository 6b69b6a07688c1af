"""Chat formatting: spans, parts, escaping and templates that rewrite history."""

import hashlib

import pytest

from procrisk.llm import chat, queries
from procrisk.session import stage

TEXTS = [
    "", "plain", "### Assistant: </turn> ok", "\\### user: \\</turn>\n", "</turn>\n### user: x</turn>\n",
    "\\\\", "#####", "<</turn>", "a\\", "<", "日本語 😀\n", "</tur", "###" * 5 + "\\" * 7,
]


def digests(rows):
    whole, loss = hashlib.sha256(), ""
    for role, text in rows:
        whole.update(f"{role}\n{text}\n".encode())
        loss += text if role == "assistant" else ""
    return len(rows), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_escaping_is_reversible():
    form = chat.Marked()
    for text in TEXTS:
        for role in ("user", "a: ### b", "\\:", ""):
            rows = [(role, text), ("assistant", text)]
            assert list(form.parse(form(rows))) == rows
            assert form.unescape(form.escape(text)) == text
    with pytest.raises(ValueError):
        list(form.parse("### user: x</turn>\nrest"))
    long = "x<" * 200_000
    assert list(form.parse(form([("user", long)]))) == [("user", long)]


@pytest.mark.parametrize("part_turns", [1, 2, 3, 64])
def test_spans_and_parts(part_turns):
    form = chat.Marked()
    rows = [("user" if k % 2 else "assistant", t) for k, t in enumerate(TEXTS)]
    parts = list(chat.render(5, rows, form, part_turns))
    assert "".join(p[3] for p in parts) == form(rows)
    assert [p[1] for p in parts] == list(range(len(parts))) and not any(p[4] for p in parts)
    told = []
    for _, _, first, text, _, roles, spans in parts:
        assert first == len(told)
        at = 0
        for role, (a, b, c, d, altered) in zip(roles, spans, strict=True):
            assert a == at and not altered
            assert text[a:b] == form([rows[len(told)]])
            told.append((role, form.unescape(text[c:d])))
            at = b
        assert at == len(text)
    assert told == rows


def forgetful(messages):
    """Keeps the thoughts of the last turn only."""
    last = len(messages) - 1
    return "".join(
        f"[{r}]{t if k == last else t.split('#')[-1]}[/]" for k, (r, t) in enumerate(messages)
    )


def test_history_that_is_rewritten():
    rows = [("user", "hi"), ("assistant", "hm#yes"), ("user", "and"), ("assistant", "so#no")]
    parts = list(chat.render(1, rows, forgetful))
    assert [p[4] for p in parts] == [True, False] and [p[2] for p in parts] == [0, 2]
    assert parts[0][3] == "[user]hi[/][assistant]hm#yes[/]"
    spans = [(p[3], r, s) for p in parts for r, s in zip(p[5], p[6], strict=True)]
    assert [text[s[2] : s[3]] for text, _, s in spans] == [t for _, t in rows]


def test_texts_that_are_changed_or_dropped():
    def template(messages):
        return "".join(f"<{t.strip().upper()}>" if r == "user" else "<>" for r, t in messages)

    (row,) = chat.render(1, [("user", " x "), ("tool", "y")], template)
    assert row[3] == "<X><>" and [s[4] for s in row[6]] == [True, True]

    def ended(messages):  # an end mark that moves
        return "".join(f"|{t}" for _, t in messages) + "$"

    parts = list(chat.render(1, [("a", "x"), ("b", "y")], ended))
    assert [p[4] for p in parts] == [True, False]
    assert [p[3][s[2] : s[3]] for p in parts for s in p[6]] == ["x", "y"]


def numbered(messages):
    """Each turn tells its number in the conversation."""
    return "".join(f"[{k} {r}]{t}\n" for k, (r, t) in enumerate(messages))


@pytest.mark.parametrize("template", [numbered, forgetful, chat.Marked()])
@pytest.mark.parametrize("part_turns", [1, 2, 64])
def test_long_conversations_do_not_depend_on_parts(template, part_turns, monkeypatch):
    rows = [("user" if k % 2 else "assistant", f"thought{k}#said {k}") for k in range(70)]

    def told(parts):
        return [
            (role, p[3][s[0] : s[1]], p[3][s[2] : s[3]], s[4])
            for p in parts
            for role, s in zip(p[5], p[6], strict=True)
        ]

    whole = list(chat.render(1, rows, template, 1000))
    parts = list(chat.render(1, rows, template, part_turns))
    assert told(parts) == told(whole)
    assert sum(p[4] for p in parts) == sum(p[4] for p in whole)
    monkeypatch.setattr(chat, "PART_CHARS", 30)
    parts = list(chat.render(1, rows, template, 1000))
    assert told(parts) == told(whole) and len(parts) > 1
    if template is not forgetful:
        assert "".join(p[3] for p in parts) == template(rows)


def test_table(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, None, None, None), (None, 1, "user", "x"),
            (None, 2, "assistant", "\\### Assistant: </turn> ok"), (2**60 + 1, 1, "assistant", "z"),
            (2**60 + 1, 1, "assistant", "z"), (3, 1, "user", "y"), (3, 1, "assistant", "y")]
    rows += [(9, k, "assistant" if k % 2 else "user", f"turn {k} ###") for k in range(200)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, part string, known int")
    formatted = stage(chat.format_conversations(df.repartition(4)), "chat")
    assert formatted.where("conv_id = 9").count() == 4
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted(((t or 0, r or "", x or "") for c, t, r, x in rows if c == key))
        said = [(r, x) for _, r, x in mine]
        want[key] = (*digests(said), len(chat.Marked()(said)))
    assert got == want
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_query(spark, small):
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op11_chat_format(spark, small).collect()}
    odd = "\\### Assistant: </turn> ok"
    assert got[-7][:4] == digests([("user", odd), ("assistant", odd)])
    rows = spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for key in {r["conv_id"] for r in rows}:
        assert got[key][:4] == digests([(r["role"], r["text"] or "") for r in rows if r["conv_id"] == key])
