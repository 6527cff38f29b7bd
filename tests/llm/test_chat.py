import random

import brute

from lendloom.llm.chat import digests, format_conversations, parse, render, spans, unescape

HARD = ["\\", "###", " ", "</turn>", "\n", ": ", "a", "Q", "Z", "#", "### assistant: ", "</turn", ">"]


def test_round_trip_of_hard_texts():
    random.seed(0)
    some = lambda n: "".join(random.choice(HARD) for _ in range(random.randint(0, n)))
    for _ in range(3000):
        turns = [(some(3), some(9)) for _ in range(3)]
        text, found = spans(turns)
        assert text == render(turns) and parse(text) == turns
        assert [unescape(text[b:c]) for _, b, c, _ in found] == [t for _, t in turns]
        assert [s[0] for s in found[1:]] == [s[3] for s in found[:-1]]


def test_black_box_templates():
    plain = lambda turns: "".join(f"<{r}>{t}</>" for r, t in turns)
    text, found = spans([("u", "hi"), ("a", ""), ("a", "yo")], plain)
    assert [text[b:c] for _, b, c, _ in found] == ["hi", "", "yo"]
    assert spans([("u", "hi"), ("a", "yo")], lambda turns: f"{len(turns)}{plain(turns)}")[1] is None
    last = lambda turns: "".join(f"{r}:{t if i == len(turns) - 1 else '-'};" for i, (r, t) in enumerate(turns))
    assert spans([("u", "hi"), ("a", "yo")], last)[1] is None


def test_rows(spark):
    rows = [(1, 1, "assistant", "b ###"), (1, 0, "user", None), (2, 0, None, "x"), (1, 2, "assistant", "Q" * 100_000), (3, 0, "assistant", "t"), (3, 0, "assistant", "t"), (4, None, "user", "first"), (4, 0, "user", "then")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, n_turns int").repartition(3)
    got = {r["conv_id"]: r for r in digests(format_conversations(df)).collect()}
    expected = {1: [("user", ""), ("assistant", "b ###"), ("assistant", "Q" * 100_000)], 2: [("", "x")], 3: [("assistant", "t")] * 2, 4: [("user", "first"), ("user", "then")]}
    for key, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[key]["n_turns"], got[key]["turns_sha256"], got[key]["loss_chars"], got[key]["loss_sha256"]) == (len(turns), brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), brute.sha(loss))
        assert got[key]["formatted_chars"] == len(render(turns))
    assert digests(format_conversations(df.limit(0))).count() == 0


def test_rewriting_is_flagged(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    assert format_conversations(df, lambda turns: f"{len(turns)}:{turns}").first()["rewrites"]


def test_every_prefix_goes_through_the_template():
    """The query's own template is a black box as well: its prefixes are rendered in order, and one that rewrites is told."""
    seen = []

    def watched(turns):
        seen.append(list(turns))
        return render(turns)

    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert spans(turns, watched)[1] == spans(turns)[1]
    assert [t for t in seen if t == turns[:len(t)]] == [turns[:1], turns[:2], turns]
    trims = lambda turns: render([(r, t if k == len(turns) - 1 else t.strip()) for k, (r, t) in enumerate(turns)])
    assert spans([("user", "a "), ("assistant", "b")], trims)[1] is None and spans([("user", "a"), ("assistant", "b ")], trims)[1] is not None
