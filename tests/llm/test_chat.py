import hashlib
import random

from mound.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["<", "~", "|im_start|>", "<|im_end|>", "<~|im_sep|>", "[INST]", "[~/INST]", "</s>", "<s>", "[", "s>", "x", "\n", "é", "$1", "\\", ""]


def rows():
    rng = random.Random(3)
    out = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "<|im_sep|>", None]), rng.choice([text, text, None])))
    return out


def test_round_trip(spark):
    data = rows()
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(data, SCHEMA)).collect()}
    for conv in {r[0] for r in data}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in data if r[0] == conv), key=lambda r: r[1])]
        assert got[conv].round_trip and [tuple(t) for t in got[conv].turns] == want
        assert got[conv].formatted.count(chat.END) == len(want)  # no control string is left in content
    plain = [r for r in got.values() if not r.escaped]
    assert plain and all(r.formatted == "".join(chat.START + a + chat.SEP + b + chat.END for a, b in r.turns) for r in plain)


def test_digest_edges(spark):
    df = spark.createDataFrame([(None, 0, "assistant", "a"), (1, None, "user", "first"), (1, 0, "assistant", None),
                                (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (2, 0, "user", "x" * 200_000)], SCHEMA)
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert got[1].n_turns == 4 and got[1].loss_chars == 2
    assert got[1].loss_sha256 == hashlib.sha256(b"bb").hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nfirst\nassistant\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[None].n_turns == 1 and got[2].loss_chars == 0
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 3, "z")], SCHEMA + ", source int, formatted string")
    assert chat.format_conversations(df).collect()[0].formatted == "<|im_start|>user<|im_sep|>a<|im_end|>"
