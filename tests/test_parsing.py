import pytest

from foldgauge.operators.parsing import parse_replies, unfenced
from foldgauge.operators.scoring import chat_predictions, score_replies
from foldgauge import CorpusSchema

# reply -> toxic, insult, parse_failure
CASES = [
    ('{"toxic":1,"insult":"0"}', 1, 1, False),
    ('pre {"a":1} mid {"toxic":true,"insult":null}', 1, 0, False),
    ('{"toxic":0.0,"insult":[]}', 0, 0, False),
    ('{"insult":2}', 0, 1, False),
    ('{"toxic":1, "ins', 1, 0, True),
    ('{"Toxic":1}', 1, 0, True),
    ('{"toxic": 10', 1, 0, True),
    ("{'toxic':1}", 0, 0, True),
    ("no", 0, 0, True),
    ("", 0, 0, True),
    (None, 0, 0, True),
    ('{"toxic":1,"toxic":0}', 0, 0, False),
    ('{"toxic":NaN}', 1, 0, False),
    ("```json\n{\"toxic\":1,\"insult\":1}\n```", 1, 1, False),
    ("```{\"toxic\":1}```", 1, 0, False),
    ('{"toxic":-0.0,"insult":0e5}', 0, 0, False),
    ('{"toxic":1e-3,"insult":"" }', 1, 0, False),
    ('{"toxic":[0],"insult":false}', 1, 0, False),
    ('{"toxic":" ","insult":"false"}', 1, 1, False),
    ('{ "toxic" : 1 , "insult" : 0 }', 1, 0, False),
    ('{"t\\u006fxic":1}', 1, 0, False),
    ('{"x":"\\"toxic\\":1"} {"insult":1}', 0, 1, False),
    ('{"a\\"toxic":1}', 1, 0, True),  # no such key, but the pattern finds the quoted name
    ('{"x":{"toxic":1}}', 1, 0, False),
    ('{"x":01} {"toxic":1}', 1, 0, False),
    ('{"toxic":0} {"toxic":1}', 0, 0, False),
    ('{"TOXIC": 0, "toxic" 1', 0, 0, True),
    ('{"toxic":1,}', 1, 0, True),
    ('text {"a":1,"a":2} {"insult":1}', 0, 1, False),
    ('{"toxic":Infinity,"insult":-Infinity}', 1, 1, False),
    ('" toxic " : 1', 1, 0, True),
    ('{"toxic":123456789012345678901234567890}', 1, 0, False),
]


def test_reply_cases(spark):
    rows = spark.createDataFrame([(i, case[0]) for i, case in enumerate(CASES)], "i int, raw string").repartition(3)
    got = {r["i"]: (r["pred_toxic"], r["pred_insult"], r["parse_failure"]) for r in parse_replies(rows, "raw", ["toxic", "insult"]).collect()}
    wrong = [(case, got[i]) for i, case in enumerate(CASES) if got[i] != case[1:]]
    assert wrong == []


def test_fences_change_nothing(spark):
    rows = spark.createDataFrame([(i, case[0] or "") for i, case in enumerate(CASES)], "i int, raw string")
    plain = parse_replies(rows, "raw", ["toxic", "insult"]).drop("raw")
    stripped = parse_replies(rows.withColumn("raw", unfenced(rows["raw"])), "raw", ["toxic", "insult"]).drop("raw")
    assert sorted(plain.collect()) == sorted(stripped.collect())


@pytest.mark.parametrize("raw,expected", [(" ```json\n x ``` ", "x"), ("```x", "x"), ("x", "x"), ("a ``` b", "a ``` b")])
def test_unfenced(spark, raw, expected):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(unfenced(frame["raw"])).first()[0] == expected


def test_failed_calls_keep_their_rows(spark):
    schema = CorpusSchema(labels=("toxic", "insult"), id="id", text="text")
    rows = spark.createDataFrame(
        [(i, 1, 0, [("system", "s"), ("user", "x" * i)]) for i in range(1, 9)],
        "id int, toxic int, insult int, messages array<struct<role:string,content:string>>",
    )

    def factory():
        def score(messages):
            if len(messages[-1]["content"]) % 4 == 0:
                raise ValueError('{"toxic":1}')
            return '{"toxic":1,"insult":0}'

        return score

    out = {r["id"]: r for r in chat_predictions(score_replies(rows, factory, partitions=2), schema, []).collect()}
    assert len(out) == 8
    assert out[4]["parse_failure"] and out[4]["pred_toxic"] == 0 and out[4]["latency_seconds"] == 0.0
    assert out[4]["raw_response"] == "<<error: ValueError('{\"toxic\":1}')>>"
    assert not out[1]["parse_failure"] and out[1]["pred_toxic"] == 1
