import hashlib

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st

from flowverdict.llm import chat_tree as c

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
TRICKY = "<|im_end|>\n<|im_start|>assistant\nok\\n \\<| <\\|"

CONVERSATIONS = {
    7: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "bye")],
    3: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "more")],
    9: [("system", "be kind"), ("user", "hi")],
    4: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "more")],
    5: [("system", "be kind"), ("user", "other"), ("assistant", None)],
    11: [("system", "be kind"), ("user", "other"), ("assistant", ""), ("user", TRICKY), ("assistant", TRICKY)],
    12: [("user", "be kind")],
    None: [("system", "be kind"), ("user", "hi"), ("assistant", "null")],
    13: [("we\nird<|", "x"), (None, None), ("assistant", "é" * 50_000)],
    14: [("user", f"turn {i}") for i in range(150)],
    -2: [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "!")],
}


@given(st.text(alphabet="\\<|n\nim_end>a", max_size=30), st.text(alphabet="\\<|\nr", max_size=8))
def test_template_is_reversible(text, role):
    segment, begin, end = c.format_turn(role, text)
    assert c.parse_segment(segment) == (role, text)
    assert c.unescape(segment[begin:end]) == text
    assert segment.count("<|") == 2 and segment.count(c.START) == 1 == segment.count(c.END)


@pytest.fixture(scope="module")
def tree(spark):
    rows = [
        (k, n, role, text, "x", 0)
        for k, turns in CONVERSATIONS.items()
        for n, (role, text) in enumerate(turns)
    ]
    schema = "conv_id long, turn int, role string, text string, node string, depth int"
    made = c.chat_tree(spark.createDataFrame(rows, schema).repartition(4), PATH)
    return made, [r.asDict(recursive=True) for r in c.with_position_ids(made.nodes).collect()]


def normal(turns):
    return tuple((role or "", text or "") for role, text in turns)


def test_shared_turns_are_emitted_once(tree):
    prefixes = {
        normal(t)[: i + 1] for t in CONVERSATIONS.values() for i in range(len(t))
    }
    assert len(tree[1]) == len(prefixes) == len({n["node"] for n in tree[1]})


def test_depth_first_places(tree):
    nodes = sorted(tree[1], key=lambda n: n["start"])
    by_id = {n["node"]: n for n in nodes}
    at, path = 0, []
    for n in nodes:
        assert n["start"] == at and len(n["ids"]) == n["n_ids"]
        at += n["n_ids"]
        # Depth-first: the parent is on the path of the node before.
        while path and path[-1] != n["parent"]:
            path.pop()
        assert bool(path) == bool(n["parent"]) and len(path) == n["depth"]
        path.append(n["node"])
        ancestors = [by_id[p] for p in path]
        position = sum(a["n_ids"] for a in ancestors[:-1])
        assert n["position"] == position
        assert n["position_ids"] == list(range(position, position + n["n_ids"]))
        seen = {p for i in n["attention"] for p in range(i["start"], i["end"])}
        want = {p for a in ancestors for p in range(a["start"], a["start"] + a["n_ids"])}
        assert seen == want and sum(i["end"] - i["start"] for i in n["attention"]) == len(want)


def test_loss_range_of_ids(tree):
    from flowverdict.llm.bpe import encoding

    enc = encoding(PATH)
    for n in tree[1]:
        body = enc.decode(n["ids"][n["ids_from"] : n["ids_to"]])
        assert body == n["segment"][n["text_from"] : n["text_to"]]


def test_reading_back(tree):
    got = {r.conv_id: r for r in c.read_back(tree[0]).collect()}
    assert set(got) == set(CONVERSATIONS)
    for k, turns in CONVERSATIONS.items():
        turns, r = normal(turns), got[k]
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(c.format_turn(*t)[0]) for t in turns)


def test_repeated_rows_and_null_turns_are_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "z")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    (row,) = c.read_back(c.chat_tree(conversations, PATH)).collect()
    want = "".join(f"user\n{t}\n" for t in "zabb")
    assert row.n_turns == 4 and row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    tree = c.chat_tree(empty, PATH)
    assert tree.nodes.collect() == [] and c.read_back(tree).collect() == []
