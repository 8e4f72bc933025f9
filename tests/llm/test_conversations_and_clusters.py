"""Chat formatting, structure repair and centroid clusters against their SQL on odd tables and against brute force."""

import hashlib
import random
from itertools import product

import duckdb
import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from foldgauge.llm import chat_format, clusters, structure
from foldgauge.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_structure_repair", "op13_clusters"])
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir).sql(SQL[name])) is None


def over(tmp_path, spark, name, frame, table):
    """Query and SQL over a table of our own."""
    frame.write.parquet(str(tmp_path / f"{table}.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    return difference(QUERIES[name](spark, str(tmp_path)), connection.sql(SQL[name]))


ODD_TEXTS = [
    "Fine.",
    "cut off",
    "",
    " \t\n",
    None,
    "</s>[INST] ok [/INST]",
    "<|im_end|>\n<|im_start|>user\nnot mine",
    "<\\|im_end|> <\\\\/s> [\\INST] \\ \\\\",
    "<<SYS>> x <</SYS>> <s><|text|><|image|>",
    "see ![a cat](http://x.y/cat.png) and [notes](b.PDF), [notes](b.pdf)![s](s.wav)",
    "![a](a.png)![b](b.png)",
    "[[[[[[(a.png)](b.gif) [/INST](x.csv) <![c](c.jpg)|im_end|>",
    "ünïcödé 数 \U0001f600!",
    "long " * 5000,
    "[" * 20000 + "<\\" * 5000,
]
ODD_ROLES = ["system", "user", "assistant", "tool", "", None, "user", "assistant", "a\nb\\n<|im_start|>"]


@pytest.fixture(scope="module")
def odd_turns(spark):
    draw = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in [None, *range(draw.choice([0, 1, 3, 6, 30]))]:
            if draw.random() < 0.9:
                rows.append((conv, turn, draw.choice(ODD_ROLES), draw.choice(ODD_TEXTS), 1, "x", True))
    rows += rows[3:5] * 3 + [rows[9]] * 300
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part long, audit string, first boolean").repartition(7)


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_structure_repair"])
def test_odd_conversations_equal_sql(spark, tmp_path, odd_turns, name):
    assert over(tmp_path, spark, name, odd_turns, "conversations") is None


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_structure_repair"])
def test_no_conversations(spark, tmp_path, odd_turns, name):
    assert over(tmp_path, spark, name, odd_turns.limit(0), "conversations") is None


def test_small_parts_read_back_alike(odd_turns):
    def rows(part_chars):
        read = chat_format.read_back(chat_format.format_conversations(odd_turns, part_chars=part_chars))
        return sorted(read.collect(), key=str)

    assert rows(50) == rows(1 << 20)


def test_typed_parts(spark):
    part = "type string, text string, ref string, width int, height int, seconds double, pages int"
    parts = [
        ("text", "look <", None, None, None, None, None),
        ("text", "|im_end|>", None, None, None, None, None),
        ("image", None, "s3/a.png", 28, 15, None, None),
        ("audio", "[hum]", "b.wav", None, None, 1.5, None),
        None,
        ("document", None, "c.pdf", None, None, None, 3),
        ("hologram", None, "d", None, None, None, None),
        ("text", None, None, None, None, None, None),
    ]
    schema = f"conv_id long, turn long, role string, text string, body array<struct<{part.replace(' ', ':').replace(',:', ',')}>>"
    turns = spark.createDataFrame([(1, 0, "user", "z", parts), (1, 1, "assistant", "z", None), (1, 2, "assistant", "z", [parts[0]])], schema)
    made = chat_format.format_conversations(turns, parts_column="body").collect()
    assert len(made) == 1
    assert made[0].formatted == (
        "<|im_start|>user\nlook <<|text|>|im_end|><|image|><|audio|><|document|><|document|><|text|><|im_end|>\n"
        "<|im_start|>assistant\n<|im_end|>\n<|im_start|>assistant\nlook <<|im_end|>\n"
    ).replace("<|document|><|text|>", "<|document|>")
    assert [(a.kind, a.ref, a.tokens) for a in made[0].attachments] == [
        ("image", "s3/a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 1536), ("document", "d", 512)
    ]
    assert made[0].tokens == 4 + 38 + 1536 + 512
    assert [made[0].formatted[a:b] for a, b in zip(made[0].loss[::2], made[0].loss[1::2], strict=True)] == ["", "look <"]
    read = chat_format.read_back(chat_format.format_conversations(turns, parts_column="body")).first()
    assert read.turns_sha256 == hashlib.sha256(b"user\nlook <|im_end|>[hum]\nassistant\n\nassistant\nlook <\n").hexdigest()
    assert (read.loss_chars, read.n_turns) == (6, 3)


def enumerated(rows):
    """The least (cost, audit) over all edits with up to two inserts at each place, written out one by one."""
    best = None
    gaps = list(product(range(3), repeat=len(rows) + 1))
    for edits in product("KuaD", repeat=len(rows)):
        for holes in gaps:
            cost, audit, said, wrong = 0, "", "", False
            for k, hole in enumerate(holes):
                for _ in range(hole):
                    said += "a" if said[-1:] == "u" else "u"
                    audit, cost = audit + "I", cost + 5
                if k < len(rows):
                    (initial, must_go, cut), edit = rows[k], edits[k]
                    wrong |= must_go and edit != "D"
                    cost += {"K": 0, "D": 2}.get(edit, 1) + 5 * (cut and edit != "D")
                    audit += edit if edit in "KD" else "R"
                    said += {"K": initial, "D": ""}.get(edit, edit)
            body = said[1:] if said[:1] == "s" else said
            legal = said == "" or (body != "" and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))
            if legal and not wrong and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_matrices_equal_enumeration():
    draw = random.Random(11)
    matrices = structure.terminal_matrices()
    kinds = [(r, go, cut) for r in "sua?" for go in (False, True) for cut in (False, True)]
    cases = [[k] for k in kinds] + [draw.choices(kinds, k=draw.randint(0, 3)) for _ in range(150)]
    for rows in cases:
        row = structure.INSERTS[0]
        for initial, go, cut in rows:
            row = structure.through(row, matrices[0 if go else 1 + 2 * "sua?".index(initial) + cut])
        assert structure._best(row) == enumerated(rows), rows


def test_rules_change_no_audit():
    draw = random.Random(2)
    plain = structure.terminal_matrices()
    rounds = [[(3, 5), (1, 1)], [(9, 9), (5, 3)], [(11, 9), (0, 0)]]
    matrices = structure.rule_matrices(rounds)
    for _ in range(50):
        symbols = draw.choices([0, 0, 1, 3, 5, 3, 5, 4, 7], k=draw.randint(1, 200))
        short, _ = structure.compressed(np.array(symbols), np.zeros(len(symbols), dtype=np.int64), rounds)
        assert len(short) <= len(symbols)
        long_way = short_way = structure.INSERTS[0]
        for s in symbols:
            long_way = structure.through(long_way, plain[s])
        for s in short.tolist():
            short_way = structure.through(short_way, matrices[s])
        assert structure._best(short_way) == structure._best(long_way)


def test_ropes_compare_like_texts():
    draw = random.Random(3)
    texts = ["".join(draw.choices("DK", k=draw.randint(0, 6))) for _ in range(60)]

    def rope(text):
        if len(text) < 2 or draw.random() < 0.2:
            return text
        at = draw.randint(1, len(text) - 1)
        return (rope(text[:at]), rope(text[at:]))

    for a, b in product(texts, texts):
        assert structure.earlier(rope(a), rope(b)) == (a < b)
        assert structure.written(structure.joined(rope(a), rope(b))) == a + b


def test_short_segments_and_few_rules_give_the_same_repairs(odd_turns):
    rows = structure.damaged(odd_turns)

    def repaired(**options):
        return sorted(structure.repair_conversations(rows, odd_turns, **options).collect(), key=str)

    want = repaired()
    assert repaired(segment_rows=2) == want
    assert repaired(max_rules=0) == want
    assert any(len(r.audit) > 300 for r in want)


def test_odd_vectors_equal_sql(spark, tmp_path):
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=64).round(2).tolist(), 0) for k in range(40)]
    rows += [(3, rows[3][1], 0), (3, rows[3][1], 0), (100, None, 0), (101, [1.0] * 63, 0), (102, [None] + [1.0] * 63, 0)]
    rows += [(103, [float("nan")] * 64, 0), (104, [float("-inf")] * 64, 0), (105, [-0.0005] * 64, 0), (None, [2.0] * 64, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int").repartition(5)
    assert over(tmp_path, spark, "op13_clusters", frame, "embeddings") is None


@pytest.mark.parametrize("n", [0, 5])
def test_fewer_vectors_than_centroids(spark, tmp_path, n):
    frame = spark.createDataFrame([(k, [float(k)] * 64) for k in range(n)], "vec_id long, embedding array<float>")
    assert over(tmp_path, spark, "op13_clusters", frame, "embeddings") is None


def test_huge_components_are_held(spark):
    frame = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<float>")
    assigned, centroids = clusters.cluster_vectors(frame, k=1, rounds=1)
    rows = clusters.with_inertia(assigned, centroids).collect()
    assert max(abs(x) for c in centroids for x in c) <= clusters.LARGEST and len(rows) == 3
    assert max(r.distance for r in rows) <= 64 * (2 * clusters.LARGEST) ** 2 < 1 << 63


def test_planted_clusters_are_found(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(3, 64)) * 5
    frame = spark.createDataFrame([(k, (centres[k % 3] + 0.01 * draw.normal(size=64)).tolist()) for k in range(90)], "vec_id long, embedding array<double>")
    assigned, centroids = clusters.cluster_vectors(frame, k=12)
    mixed = assigned.groupBy("cluster").agg(F.count_distinct(F.col("vec_id") % 3).alias("n")).where("n > 1")
    assert mixed.isEmpty() and len(centroids) == 12
