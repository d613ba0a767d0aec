import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import chat

bits = st.lists(st.sampled_from(["<", "|", ">", "[", "/", "INST]", "s>", "\\", "<s>", "</s>", "<|turn|>", "[INST]", "|>", "a", "é", "😀", "\n", "n"])).map("".join)


@settings(max_examples=400, deadline=None)
@given(bits)
def test_escape_round_trip(text):
    broken = chat.escape(text)
    assert chat.unescape(broken) == text
    assert not any(c in broken for c in ("<s>", "</s>", "<|", "|>", "[INST]", "[/INST]"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(bits, bits), max_size=4))
def test_read_back(turns):
    f = chat.Flattener()
    for role, text in turns:
        f.turn(role, [{"kind": "text", "text": text}])
    whole = "".join(f.out)
    assert chat.read_back(whole) == turns and f.length == len(whole)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(bits, st.sampled_from([None, "image", "video"])), max_size=5), max_size=3))
def test_neighbouring_parts(turns):
    """Whatever parts a text is cut into, it comes back whole and holds no control string."""
    f, images = chat.Flattener(), ("image", "video")
    for n, content in enumerate(turns):
        f.turn("assistant" if n % 2 else "user", [None if p is None else {"kind": p, "ref": "r", "width": 1, "height": 1} if p in images else {"kind": "text", "text": p} for p in content])
    whole = "".join(f.out)
    said = [("assistant" if n % 2 else "user", "".join(p for p in content if p not in images and p is not None)) for n, content in enumerate(turns)]
    assert chat.read_back(whole) == said and f.length == len(whole)
    assert "".join(chat.unescape(whole[a:b]) for a, b in f.spans) == "".join(t for r, t in said if r == "assistant")
    assert [whole[a["position"] :].startswith(f"<|{'image' if a['kind'] == 'image' else 'file'}:{a['no']}|>") for a in f.attachments] == [True] * len(f.attachments)
    assert whole.count("</s>") == len(turns) and "[INST]" not in whole and "[/INST]" not in whole


def test_control_strings_across_parts():
    f = chat.Flattener()
    for content in (["a<", "/s>b"], ["[INST", "] c"], ["<", "|tu", "rn|", ">"], ["<\\", "s>"]):
        f.turn("assistant", [{"kind": "text", "text": t} for t in content])
    assert chat.read_back("".join(f.out)) == [("assistant", t) for t in ("a</s>b", "[INST] c", "<|turn|>", "<\\s>")]


def test_parts(spark):
    part = lambda **k: {"kind": "text", "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k
    content = [part(text="look </s>"), part(kind="image", ref="i.png", width=28, height=15), None, part(kind="audio", ref="a", seconds=1.01), part(kind="document", ref="d", pages=2), part(kind="video", ref="v")]
    rows = [(1, 0, "user", content), (1, 1, "assistant", [part(text="I see "), part(kind="image", ref="j", width=1, height=1), part(text="two")]), (2, 0, None, None), (None, 5, "assistant", [part()])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    one = got[1]
    assert [(a.no, a.kind, a.ref, a.turn_no, a.tokens) for a in one.attachments] == [(1, "image", "i.png", 0, 4), (2, "audio", "a", 0, 26), (3, "document", "d", 0, 1152), (4, "file", "v", 0, 0), (5, "image", "j", 1, 1)]
    assert one.attachment_tokens == 1183 and one.n_turns == 2
    assert [one.formatted[s.start : s.end] for s in one.loss_spans] == ["I see ", "two"]
    for a in one.attachments:
        assert one.formatted[a.position :].startswith(f"<|{a.kind}:{a.no}|>")
    assert chat.read_back(one.formatted) == [("user", "look </s>"), ("assistant", "I see two")]
    assert got[2].n_turns == 1 and got[None].n_turns == 1 and got[None].loss_spans == []


def test_plain_conversations(spark):
    rows = [(3, 1, "assistant", "b"), (3, 0, "user", "a é"), (3, 1, "assistant", "b"), (4, 0, "assistant", None), (4, 1, None, "x" * 100000), (5, 2, "assistant", "[INST]\\<|"), (5, None, "system", "first")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(chat.text_parts(df))).collect()}
    want = {3: [("user", "a é"), ("assistant", "b"), ("assistant", "b")], 4: [("assistant", ""), ("", "x" * 100000)], 5: [("system", "first"), ("assistant", "[INST]\\<|")]}
    for c, turns in want.items():
        r, loss = got[c], "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digest(chat.format_conversations(chat.text_parts(df.limit(0)))).collect() == []
