import hashlib

from pyspark.sql import functions as F

from foldgauge import CorpusSchema
from foldgauge import fixed_values as V
from foldgauge.functions.labels import labels_json
from foldgauge.functions.scores import token_budget
from foldgauge.functions.text import render_messages, token_window, tokens, truncate_clean
from foldgauge.operators import prompts as P
from foldgauge.operators import splitting as S


def key(row_id, seed=0):
    return int(hashlib.md5(f"{seed}|{row_id}".encode()).hexdigest()[:15], 16)


def brute_exemplars(corpus, roles, labels, k):
    rows = {r["id"]: r for r in corpus.collect()}
    out = []
    for fold in range(k):
        train = [rows[r["id"]] for r in roles if r["fold"] == fold and r["role"] == "train"]
        card = lambda r: sum(r[x] for x in labels)
        place = lambda r: (key(r["id"]), r["id"])
        for slot, label in enumerate(labels):
            candidates = sorted((r for r in train if r[label]), key=lambda r: (card(r) != 1, *place(r)))
            out += [(fold, slot, candidates[0]["id"])] if candidates else []
        clean = sorted((r for r in train if card(r) == 0), key=place)
        out += [(fold, len(labels) + i, r["id"]) for i, r in enumerate(clean[:2])]
    return sorted(out)


def test_exemplars_equal_brute_force(corpus, schema):
    roles = S.fold_roles(corpus, schema, k=3)
    chosen = P.few_shot_exemplars(corpus, roles, schema, n_folds=3)
    got = sorted((r["fold"], r["slot"], r["id"]) for r in chosen.collect())
    assert got == brute_exemplars(corpus, roles.collect(), schema.labels, 3)
    assert {(r["multi_role"], r["exemplars_outside_train"]) for r in S.leakage_check(roles, chosen, schema).collect()} == {(0, 0)}


def test_leaks_are_found(corpus, schema):
    roles = S.fold_roles(corpus, schema, k=3)
    leaked = roles.where("role = 'test'").select("fold", "id").limit(4)
    assert S.leakage_check(roles, leaked, schema).agg(F.sum("exemplars_outside_train")).first()[0] == 4
    doubled = roles.unionByName(roles.where("fold = 1 and role = 'test'").limit(2).withColumn("role", F.lit("train")))
    assert S.leakage_check(doubled, leaked, schema).agg(F.sum("multi_role")).first()[0] == 2


def test_fallback_and_empty_slots(spark, schema):
    rows = [("r1", "x", 1, 1, 0), ("r2", "y", 1, 1, 0), ("r3", "z", 0, 0, 0)]
    corpus = spark.createDataFrame(rows, "id string, text string, a int, b int, c int")
    roles = corpus.select(F.lit(0).alias("fold"), "id", F.lit("train").alias("role"))
    got = sorted((r["slot"], r["id"]) for r in P.few_shot_exemplars(corpus, roles, schema, 1).collect())
    first = min(("r1", "r2"), key=key)
    assert got == [(0, first), (1, first), (3, "r3")]
    assert sorted(r["slot"] for r in P.few_shot_exemplars(corpus, roles, schema, 1, k=2).collect()) == [0, 1]


def test_six_label_prompts(spark):
    schema = CorpusSchema()
    rows = [("q", "hello\nworld &amp; more", 1, 0, 0, 0, 1, 0)]
    frame = spark.createDataFrame(rows, schema.struct_type().simpleString()[7:-1].replace(":", " "))
    messages = P.zero_shot_messages(frame, schema).first()["messages"]
    assert [m["role"] for m in messages] == ["system", "user"]
    assert messages[0]["content"] == V.SYSTEM_PROMPT
    assert messages[1]["content"] == "Classify the following comment.\n\nComment: hello world & more\n\nJSON:"
    exemplars = frame.select(F.lit(0).alias("fold"), F.lit(0).alias("slot"), "id", F.lit("ex").alias("text"), *schema.labels)
    few = P.few_shot_messages(frame.withColumn("fold", F.lit(0)), exemplars, schema).first()["messages"]
    assert few[1]["content"] == (
        "Here are labeled examples. After them, classify the new comment.\n\nComment: ex\nJSON: "
        '{"toxic":1,"severe_toxic":0,"obscene":0,"threat":0,"insult":1,"identity_hate":0}\n\n'
        "Now classify this comment.\n\nComment: hello world & more\n\nJSON:"
    )
    template = {r["mode"]: r["template"] for r in P.prompt_templates(exemplars, exemplars.select('fold').distinct(), schema).collect()}
    assert template["zero_shot"].endswith("[USER]\nClassify the following comment.\n\nComment: <<COMMENT_TEXT>>\n\nJSON:")
    assert "<<COMMENT_TEXT>>" in template["few_shot"] and "Comment: ex" in template["few_shot"]


def test_truncation_counts_code_points(spark):
    texts = ["x" * 800, "x" * 801, "\U0001f600" * 801, " pad \n line ", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["o"] for r in frame.select("i", truncate_clean(F.col("t")).alias("o")).collect()}
    assert got == {0: "x" * 800, 1: "x" * 800 + " ...", 2: "\U0001f600" * 800 + " ...", 3: "pad   line", 4: ""}


def test_tokens(spark):
    frame = spark.createDataFrame([("a b\t c",), ("",), ("  ",)], "t string")
    rows = frame.select(tokens(F.col("t")).alias("all"), token_window(F.col("t"), 2).alias("cut")).collect()
    assert [(r["all"], r["cut"]) for r in rows] == [(["a", "b", "c"], ["a", "b"]), ([], []), ([], [])]


def test_labels_json_and_rendering(spark):
    frame = spark.createDataFrame([(1, None, [("system", "s"), ("user", "u")])], "a int, b int, m array<struct<role:string,content:string>>")
    row = frame.select(labels_json(["a", "b"]).alias("j"), render_messages(F.col("m")).alias("r")).first()
    assert row["j"] == '{"a":1,"b":0}' and row["r"] == "[SYSTEM]\ns\n\n[USER]\nu"


def test_token_budget(spark):
    frame = spark.createDataFrame(
        [("llama3:8b", True, 64), ("GPT-OSS:latest", True, 64), ("gpt-oss:latest", False, 64), ("qwq", True, 4096), ("o1-mini", False, 600)],
        "model string, think boolean, n int",
    )
    budgets = [r[0] for r in frame.select(token_budget(F.col("model"), F.col("think"), F.col("n"))).collect()]
    assert budgets == [64, 2048, 512, 4096, 600]


def test_clean_negatives(corpus, schema):
    used = corpus.where("id = 'id0001'")
    rows = {r["id"] for r in P.clean_negatives(corpus, schema, used).collect()}
    assert "id0001" not in rows and "id0002" in rows and "id0000" not in rows
