import unicodedata

import pytest
from pyspark.sql import functions as F

from foldgauge.operators import cleaning as C

CASES = [
    ("a &lt;b&gt;x&lt;/b&gt; y", "a x y"),
    ("[[User talk:Bob|hi]] said [[Page|Text]] and [[Foo]] ~~~~", "<USER> said Page and Foo"),
    ("== Head ==\nbody {{tl|x}}", "Head body"),
    ("see HTTPS://X.y/z?q=1 now www.a.b", "see <URL> now <URL>"),
    ("ip 10.0.0.1 and 1.2.3.4.5 999.999.999.999", "ip <IP> and <IP> .5 <IP>"),
    ("&#8203;z​z q&nbsp;w", "​zz q w"),
    ("ﬁ Ⅷ １２", "fi VIII 12"),
    ("a\u001cb\u001fc", "a b c"),
    ("i < 3 and j > 2", "i 2"),
    ("==a=b==", "==a=b=="),
    ("é1.2.3.4 x1.2.3.4", "é1.2.3.4 x1.2.3.4"),
    (None, ""),
    ("", ""),
    # entities: each text is unescaped exactly once, whichever way it takes
    ("&amp;lt;b&amp;gt;", "&lt;b&gt;"),
    ("&amp;lt;b&amp;gt; …", "&lt;b&gt; ..."),
    ("AT&T & co &", "AT&T & co &"),
    ("&copy; &ampx &notit; &#65; &#x42;", "© &x ¬it; A B"),
    ("&amp;amp; &quot;q&quot; &#39;s&#39;", "&amp; \"q\" 's'"),
    ("＆lt;x＆gt;", ""),
    # combining marks compose, compatibility forms fold
    ("é Å ẛ̣", "é Å ṩ"),
    # the contributions form needs a second colon to count as a user link
    ("[[user:A]] [[ SPECIAL:Contributions : x]] [[Special:Contributions/1.2.3.4]] [[x", "<USER> <USER> Special:Contributions/ <IP> [[x"),
    ("a  b\t\n c d ", "a b c d"),
    ("\U0001f600 ok", "\U0001f600 ok"),
]


def test_hand_cases(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    cleaned = C.clean_corpus(spark.createDataFrame(rows, "i int, text string"), "text").collect()
    got = {row["i"]: row["cleaned"] for row in cleaned}
    assert [got[i] for i in range(len(CASES))] == [expected for _, expected in CASES]


def test_disabled_keeps_text(spark):
    rows = spark.createDataFrame([(0, " a &amp; <b> "), (1, None)], "i int, text string")
    got = {r["i"]: r["cleaned"] for r in C.clean_corpus(rows, "text", enabled=False).collect()}
    assert got == {0: " a &amp; <b> ", 1: ""}


def _stable_characters():
    text = C.NFKC_STABLE.replace(r"\u0000-\u007F", "")
    out, i = set(range(0x80)), 0
    while i < len(text):
        if i + 2 < len(text) and text[i + 1] == "-":
            out |= set(range(ord(text[i]), ord(text[i + 2]) + 1))
            i += 3
        else:
            out.add(ord(text[i]))
            i += 1
    return out


def test_stable_characters_are_stable():
    stable = _stable_characters()
    assert 0x4E00 in stable and 0xE9 in stable and 0x200B not in stable
    changed = [c for c in stable if unicodedata.normalize("NFKC", chr(c)) != chr(c) or unicodedata.combining(chr(c))]
    assert changed == []
    followers = set()
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            followers.add(int(parts[1], 16))
    assert stable & followers == set()


@pytest.mark.parametrize("text", ["plain ascii", "été 你好", "a &lt; b", "x & y", "&copy; a &middot; b", "שלום مرحبا नमक กขค", "\U0001f600 ok"])
def test_usual_texts_stay_in_the_jvm(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(F.col("t").rlike(C.NEEDS_PYTHON).alias("p")).first()
    assert row["p"] is False


# Recorded pairs: random mixtures of everything the rules react to, and what each cleans to.
RECORDED = [
    ('|User_talk:.-\u2026==1.2.3.4.e\u0301~~1=\t\n->=\x1c\t.', '|User_talk:.-...== <IP> .\xe9~~1= ->= .'),
    ('[[<. User_talk:.<1\x1c]]&amp;\n|\u2026[[ &lt;\x1c}}== ~~~1.2.3.4==\x1c- .~~\xe9\u2026\t&copy;\u200b\u200b1.2.3.4', '<. User_talk:.<1 & |...[[ < }} <IP> - .~~\xe9... \xa9 <IP>'),
    ('>}}>= &lt;\uff21\xe9http://\xa0&amp;-[[e\u0301\n{{http://|\xe9', '>}}>= <A\xe9http:// &-[[\xe9 {{ <URL>'),
    ('1-\x1c &copy;http://www.\xe9\u200b-=;\ufeff-.&lt; \xa0&amp;User:www.b\u200bwww.{{[[', '1- \xa9 <URL> &User: <URL>'),
    ('.~~&amp;]]>User_talk:User_talk:\xe9={{\xa0User_talk:\x1c;]]\t\x1c;\nwww.User:<|=}}|<<a\xe9}}', '.~~&]]>User_talk:User_talk:\xe9= |<<a\xe9}}'),
    ('&amp;a|\n\u20261.2.3.4 &copy;]]e\u0301.\u200b\x1cUser_talk:User_talk:User_talk:', '&a| ... <IP> \xa9]]\xe9. User_talk:User_talk:User_talk:'),
    ('==\ufeffUser_talk:.~~~-~~\xa0{{[[http://.==a |\u2026==1.2.3.4b-~~User:|&', 'User_talk:. -~~ {{[[ <URL> a |...==1.2.3.4b-~~User:|&'),
    ('1.2.3.4\ufeff[[[[\xe9\u200b\ufeff\ufeff&lt;=|==http://&\ufeff{{\uff21b~~\uff211.2.3.4|', '<IP> [[[[\xe9<=|== <URL>'),
    ('b\uff21&lt;=&\uff211.2.3.4{{www.<\u2026\u2026e\u0301http://<~~~>User_talk:<~~~\uff21\xe9www.bb;\ufeff&~~~www.\xa0www.1.2.3.4=', 'bA User_talk:< A\xe9 <URL> www. <URL>'),
    ('==<\ufeff~~~http://~~\ufeffa\ufeffwww.=[[User:~~~', '==< <URL>'),
    ('}}\thttp://=User_talk:\u200bUser_talk:={{{{]]b|\u200b|\ufeffwww.|\x1c\x1c]]ba==\uff21]]\t~~~~~b', '}} <URL> ]]ba==A]] b'),
    ('~~&amp;e\u0301>&copy;&\u2026\n]].www.\u200b\uff21\ne\u0301]]', '~~&\xe9>\xa9&... ]]. <URL> \xe9]]'),
    ('|\uff21e\u0301b\xa0}}a|}}|\ufeff[[\x1c.&copy;\uff21\uff21\x1c\ufeff==\x1c.>~~~;1==e\u0301\xa0\x1cb-\xa0&copy;', '|A\xe9b }}a|}}|[[ .\xa9AA .> ;1 \xe9 b- \xa9'),
    ('e\u0301e\u0301~~~;\xa0e\u0301\u2026\ufeffe\u0301>\uff21&\x1c~~~\xa0]]\n[[User_talk:\xa0&copy;->\t-~~&lt;[[|1.2.3.4|&]]\u200b<==User_talk:\xe9{{', '\xe9\xe9 ; \xe9...\xe9>A& ]] User_talk: \xa9-> -~~<[[<==User_talk:\xe9{{'),
    ('{{\te\u0301User_talk:http://\n~~~www.&copy;=1.2.3.4bhttp://\x1c', '{{ \xe9User_talk:http:// <URL>'),
    ('\xa0bUser:http://\uff21&amp;e\u0301-[[<===&;1}};]]\t&User_talk:|\u2026e\u0301 \xe9&copy;=;', 'bUser: <URL> &User_talk:|...\xe9 \xe9\xa9=;'),
    ('b=&=<-&[[\u200bahttp://\x1c\n;]]1\uff21', 'b=&=<-&ahttp:// ;1A'),
    ('[[{{&.}}~~~&lt;&lt;\uff21~~&amp;\xa0e\u0301}};', '[[ <<A~~& \xe9}};'),
    ('b&1abe\u0301\x1c~~~e\u0301\ufeff>\xa0==\t\xe9\u2026User_talk:e\u0301&lt;~~<http://', 'b&1ab\xe9 \xe9> == \xe9...User_talk:\xe9<~~<http://'),
    (']]User_talk:www..]]a-&\t{{.=', ']]User_talk: <URL> {{.='),
    ('e\u0301&amp;>&amp;1\u200b}}{{;\xa0a&1.2.3.4http://\x1c&copy;>1&lt;~~www.}}ahttp://', '\xe9&>&1}} ahttp://'),
    ('=\ufeff;e\u0301~~~>e\u0301a=&=|User_talk:1User_talk:b&lt;&lt;<=\uff21|User:&copy;', '=;\xe9 >\xe9a=&=|User_talk:1User_talk:b<<<=A|User:\xa9'),
    ('|&amp;|1e\u0301\te\u0301]]\uff21e\u0301 b<=b1]]1.2.3.4==User:\xa0\x1c.b\u2026>\xe9&a\u200b-', '|&|1\xe9 \xe9]]A\xe9 b \xe9&a-'),
    ('\u2026=\uff21-\ufeff&-&>~~<\u200b\xe9User:-\ufeff&amp;1~~~-|http://&&lt; ]]a\ufeff.\xe9;==', '...=A-&-&>~~<\xe9User:-&1 -| <URL> ]]a.\xe9;=='),
    ('\xe9&amp;\uff21&amp;\u200b\u200b\u200b[[\x1c~~~&lt;=\ufeff', '\xe9&A&[[ <='),
    ('-e\u0301\xa0;User:~~~~-=|\uff21&1.2.3.4]]e\u0301;[[1.2.3.4<\xe9\xe9User_talk:b{{a\xe9\xa0User_talk:&lt;', '-\xe9 ;User: -=|A& <IP> ]]\xe9;[[ <IP> <\xe9\xe9User_talk:b{{a\xe9 User_talk:<'),
    ('\nwww.User:&copy;[[http://a&copy;http://', '<URL>'),
    ('[[~~~a&amp;&1.2.3.4-User_talk:User:-1.2.3.4\t;.;==.&amp;|>;\te\u0301&copy;~~~', '[[ a&& <IP> -User_talk:User:- <IP> ;.;==.&|>; \xe9\xa9'),
    ('\tbUser_talk:\x1c\x1c~~=.\n\xa0]]&amp;\xe9.\x1c]]{{\ufeff\nhttp://&amp;&lt;&', 'bUser_talk: ~~=. ]]&\xe9. ]]{{ <URL>'),
    ('User_talk:>&lt;\ufeff\x1cUser_talk:[[{{{{-~~e\u0301\xe9\x1c<\xa0', 'User_talk:>< User_talk:[[{{{{-~~\xe9\xe9 <'),
    ('\xa0\t]]\x1c~~~>=}}http://\x1c=&copy;>1.2.3.4& ~~~b\nUser:\n', ']] >=}}http:// =\xa9> <IP> & b User:'),
    ('~~User:;http://.\xe9; 1.2.3.4]]e\u0301\uff21~~=;>User:User_talk:\xa0\t&lt;b]]1\t\ufeff\xe9a-User_talk:\uff21\u200b\xa0', '~~User:; <URL> <IP> ]]\xe9A~~=;>User:User_talk: <b]]1 \xe9a-User_talk:A'),
    ('==<||\uff21==\u200b=\x1c1a]]< 1', '<||A 1a]]< 1'),
    (']]&\uff21\t[[==-&lt;\uff21~~~User:&<aa\u2026&lt;\u200b;', ']]&A [[==-<A User:&<aa...<;'),
    ('>\ufeff\uff21>\x1c>b\n&lt;.b~~~\xe9\n=&<\t1.2.3.4<', '>A> >b <.b \xe9 =&< <IP> <'),
    ('1http://\n1.2.3.4User_talk:~~~a&amp;e\u0301-~~\xe9~~~&lt;~~~<\u200b<&&amp;==\xe9}}<\xe9\n.|User_talk:.~~', '1http:// 1.2.3.4User_talk: a&\xe9-~~\xe9 < <<&&==\xe9}}<\xe9 .|User_talk:.~~'),
]


def test_few_pages_need_python(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert pages.where(F.col("html").rlike(C.NEEDS_PYTHON)).count() <= 0.05 * pages.count()


def test_recorded_texts(spark):
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(RECORDED)], "i int, text string").repartition(4)
    got = {r["i"]: r["cleaned"] for r in C.clean_corpus(frame, "text").collect()}
    assert [got[i] for i in range(len(RECORDED))] == [expected for _, expected in RECORDED]


def test_users_columns_survive(spark):
    rows = spark.createDataFrame([("x <b> y", "mine", "mine too", 3)], "text string, cleaned string, tagless string, before_cleaning int")
    row = C.clean_corpus(rows, "text", out="done").first()
    assert row.asDict() == {"text": "x <b> y", "cleaned": "mine", "tagless": "mine too", "before_cleaning": 3, "done": "x y"}


@pytest.mark.parametrize("text", ["<" * 100_000, "==" + " " * 100_000 + "x", "[[" * 50_000, "[[User:" * 15_000, "a>" + "<b" * 50_000, "{{" * 50_000])
def test_long_texts_take_linear_time(spark, text):
    import time

    begun = time.perf_counter()
    C.clean_corpus(spark.createDataFrame([(text,)], "text string"), "text").collect()
    assert time.perf_counter() - begun < 20


@pytest.mark.parametrize(
    "text",
    [
        "[[User:" * 15_000 + "]x]]",
        "[[a" * 33_000 + "]x]]",
        "[[a" * 33_000 + "|]]",
        "[[User:a]" * 12_000,
        "[[|" * 33_000 + "]]",
        "[[a|" * 25_000 + "]]",
        "]" * 100_000,
        "[[ " + " " * 100_000 + "]]",
    ],
)
def test_links_take_linear_time(spark, text):
    import time

    frame = spark.createDataFrame([(text,)], "text string")
    C.clean_corpus(frame.limit(0), "text").collect()
    begun = time.perf_counter()
    C.clean_corpus(frame, "text").collect()
    assert time.perf_counter() - begun < 2


def test_links_equal_their_patterns(spark):
    """The linear link rules against the plain patterns, on every short mixture of brackets and bars."""
    import random
    import re

    draw = random.Random(1)
    pieces = ["[", "[", "[[", "]", "]]", "|", "a", "\n", "b c", "[[User:", "[[ user talk :", "[[Special:Contributions:x"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(1, 14))) for _ in range(4000)]
    rules = {rule.name: rule for rule in C.STRUCTURAL_RULES}
    patterns = {name: pattern.replace("@B", r"\s") for name, pattern, _ in C.V.CLEANING}
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = frame.select("i", rules["user_link"].apply(F.col("t")).alias("u"), rules["wiki_link"].apply(F.col("t")).alias("w")).collect()
    for i, user, page in got:
        assert user == re.sub(patterns["user_link"], " <USER> ", texts[i]), texts[i]
        assert page == re.sub(patterns["wiki_link"], r"\1", texts[i]), texts[i]


def test_marked_texts_meet_every_wiki_rule(spark, sf_dir):
    from foldgauge.queries import QUERIES

    rows = QUERIES["clean_audit_marked"](spark, sf_dir).groupBy("rule").agg(F.sum("rows_changed").alias("n")).collect()
    assert all(r["n"] > 0 for r in rows if r["rule"] in C.WIKI_RULES) and len(rows) == 10


def test_audit_counts(spark):
    rows = spark.createDataFrame([("en", "a <b> c"), ("en", "a  b"), ("fr", "~~~~")], "lang string, text string")
    audit = {(r["lang"], r["rule"]): (r["rows_changed"], r["chars_removed"]) for r in C.clean_audit(rows, "text", ["lang"]).collect()}
    assert audit["en", "html_tag"] == (1, 2)
    assert audit["en", "blank_run"] == (2, 3)
    assert audit["fr", "signature"] == (1, 3)
    assert audit["fr", "url"] == (0, 0)


def test_blank_runs_without_looking_back(spark):
    """The rule against its plain definition for every short run of blanks; a look back at each lone space took as long as all other rules."""
    blanks = [" ", "\t", "\n", "\u001c", "\u0085", " ", " ", "　", "a", "\U0001f600"]
    texts = [(f"x{a}{b}{c}{d}",) for a in blanks for b in blanks for c in blanks for d in (" ", "\t", "é", "")]
    rule = next(rule for rule in C.STRUCTURAL_RULES if rule.name == "blank_run")
    df = spark.createDataFrame(texts, "text string")
    plain = F.regexp_replace("text", F.lit(rf"(?U){C.V.BLANK}+"), F.lit(" "))
    assert df.where(rule.apply(F.col("text")) != plain).count() == 0
    assert "(?<" not in rule.pattern
