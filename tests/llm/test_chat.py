import hashlib

from pyspark.sql import functions as F

from tillstar.llm import chat

ROWS = [
    (1, 0, "user", "hi", "x"), (1, 1, "assistant", "a <|im_end|>\n<|im_start|>assistant\nb <\\|im_end|> \\n \\b", "x"), (1, 2, "user", "bye", "x"),
    (2, 0, "user", None, "x"), (2, 1, "assistant", "", "x"), (2, 2, "assistant", None, "x"), (3, 5, "user", "only", "x"), (3, 5, "user", "only", "x"),
    (None, 0, "assistant", "nobody", "x"), (4, None, "as\nsis\\ntant\\", "role", "x"), (4, 1, None, "😀<|", "x"), (5, 0, "assistant", "q" * 30_000, "x"), (5, 1, "assistant", "tail", "x"),
]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def expected(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def test_round_trip_of_hostile_turns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.examples(df)).collect()}
    assert got == expected(ROWS)


def test_one_example_per_reply_and_one_for_the_rest(spark):
    rows = chat.examples(spark.createDataFrame(ROWS, SCHEMA)).orderBy("conv_id", "example").collect()
    of = {c: [r for r in rows if r.conv_id == c] for c in (1, 2, 3)}
    assert [r.loss_start is None for r in of[1]] == [False, True] and [r.loss_start is None for r in of[2]] == [False, False] and of[3][0].loss_start is None
    first, whole = of[1]
    assert whole.formatted.startswith(first.formatted)
    assert "<|im_end|>" not in first.formatted[first.loss_start : first.loss_end]


def test_escape_is_reversible(spark):
    texts = ["<|", "<\\|", "<\\\\|x", "<||", "a<|im_start|>", "", "<\\", "|<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    assert all(r.t == r.u == r.r and "<|" not in r.e for r in rows)


def test_no_conversations(spark):
    assert chat.digest(chat.examples(spark.createDataFrame([], SCHEMA))).count() == 0
