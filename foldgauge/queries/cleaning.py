"""Corpus cleaning over whole texts."""

from foldgauge import fixed_values as V
from foldgauge.functions.text import token_window, tokens
from foldgauge.operators.cleaning import clean_audit, clean_corpus
from foldgauge.queries.base import query, table
from pyspark.sql import functions as F

# The SQL engine knows no NFKC and no entity function. The given texts do not change under NFKC, and the
# entities in them are listed here; the tests check the full rules on hand cases.
SQL_BLANK = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STEPS = (
    ("hygiene", None, None),
    *((name, pattern.replace("@B", f"[{SQL_BLANK}]").replace("@N", f"[^{SQL_BLANK}]"), shown) for name, pattern, shown in V.CLEANING),
)


# The rules leave the blanks inside a heading to the last rule; texts come out alike, but an audit counts them there.
STAGED_HEADING = {"wiki_heading": r"={2,}([^=]+)={2,}"}


def steps_sql(source: str, keep: str, text: str, instead: dict[str, str] | None = None) -> str:
    """CTEs ``s_<rule>``, each adding the text after one rule."""
    unescaped = f"coalesce({text}, '')"
    for entity, character in (("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("copy", "'©'"), ("middot", "'·'"), ("nbsp", "chr(160)"), ("#39", "chr(39)"), ("amp", "'&'")):
        # these names also count without their semicolon
        unescaped = f"regexp_replace({unescaped}, '&{entity};?', {character}, 'g')"
    ctes = [f"s_hygiene AS (SELECT {keep}, coalesce({text}, '') AS t_source, {unescaped} AS t_hygiene FROM {source})"]
    previous = "hygiene"
    for name, pattern, replacement in STEPS[1:]:
        pattern = (instead or {}).get(name, pattern)
        ctes.append(
            f"s_{name} AS (SELECT *, regexp_replace(t_{previous}, '{pattern}', '{replacement}', 'g') AS t_{name} FROM s_{previous})"
        )
        previous = name
    return ", ".join(ctes)


def audit_sql(source: str, by: str, text: str) -> str:
    names = [name for name, _, _ in STEPS]
    rows = []
    for before, after in zip(["source", *names[:-1]], names):
        rows.append(
            f"""SELECT {by}, count(*) AS n_rows, '{after}' AS rule, count(*) FILTER (t_{before} <> t_{after}) AS rows_changed,
  CAST(sum(length(t_{before}) - length(t_{after})) AS BIGINT) AS chars_removed FROM s_blank_run GROUP BY {by}"""
        )
    return f"WITH {steps_sql(source, by, text, STAGED_HEADING)} " + " UNION ALL ".join(rows)


@query(
    "clean_documents",
    f"WITH {steps_sql('documents', 'doc_id, lang, source', 'text')} SELECT doc_id, lang, source, trim(t_blank_run) AS cleaned FROM s_blank_run",
)
def documents(spark, sf_dir):
    return clean_corpus(table(spark, sf_dir, "documents"), "text").select("doc_id", "lang", "source", "cleaned")


@query(
    "clean_pages",
    f"WITH {steps_sql('pages', 'page_id, url', 'html')} SELECT page_id, url, trim(t_blank_run) AS cleaned FROM s_blank_run",
)
def pages(spark, sf_dir):
    return clean_corpus(table(spark, sf_dir, "pages"), "html").select("page_id", "url", "cleaned")


@query(
    "clean_conversations",
    f"WITH {steps_sql('conversations', 'conv_id, turn', 'text')} SELECT conv_id, turn, trim(t_blank_run) AS cleaned FROM s_blank_run",
)
def conversations(spark, sf_dir):
    return clean_corpus(table(spark, sf_dir, "conversations"), "text").select("conv_id", "turn", "cleaned")


# Frequent words of the given texts, and the wiki marks put in their place; links with a single bracket or an empty part stay.
MARKS = (
    (" the ", " [[User talk:Ann|the]] "),
    (" of ", " [[of]] "),
    (" and ", " {{tl|and}} "),
    (" to ", " [[to]x]] "),
    (" in ", " [[in|side]] "),
    (" is ", " [[is|]] "),
    ("e. ", "e. == Note ==\n"),
    ("s. ", "s. ~~~~ "),
    (" a ", " [[a]]] "),
)


def marked_sql(source: str) -> str:
    text = "text"
    for plain, mark in MARKS:
        text = f"replace({text}, '{plain}', '{mark}')"
    return f"(SELECT doc_id, lang, {text} AS text FROM {source})"


def marked_documents(spark, sf_dir):
    """The documents as wiki pages would hold them."""
    text = F.col("text")
    for plain, mark in MARKS:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("text"))


@query(
    "clean_marked_documents",
    f"WITH {steps_sql(marked_sql('documents'), 'doc_id, lang', 'text')} SELECT doc_id, lang, trim(t_blank_run) AS cleaned FROM s_blank_run",
)
def clean_marked(spark, sf_dir):
    """The wiki rules at work: user and page links, templates, headings, signatures."""
    return clean_corpus(marked_documents(spark, sf_dir), "text").select("doc_id", "lang", "cleaned")


@query("clean_audit_marked", audit_sql(marked_sql("documents"), "lang", "text"))
def audit_marked(spark, sf_dir):
    return clean_audit(marked_documents(spark, sf_dir), "text", ["lang"])


@query("cleaning_disabled", "SELECT doc_id, coalesce(text, '') AS cleaned FROM documents")
def disabled(spark, sf_dir):
    return clean_corpus(table(spark, sf_dir, "documents"), "text", enabled=False).select("doc_id", "cleaned")


@query("clean_audit", audit_sql("documents", "lang, source", "text"))
def audit(spark, sf_dir):
    return clean_audit(table(spark, sf_dir, "documents"), "text", ["lang", "source"])


@query("clean_audit_pages", audit_sql("(SELECT 'pages' AS kind, html FROM pages)", "kind", "html"))
def audit_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("kind"), "html")
    return clean_audit(pages, "html", ["kind"])


@query(
    "token_truncate",
    f"""WITH {steps_sql('documents', 'doc_id', 'text')}, words AS (
  SELECT doc_id, CASE WHEN trim(t_blank_run) = '' THEN [] ELSE string_split(trim(t_blank_run), ' ') END AS w FROM s_blank_run
) SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, len(w) > 512 AS truncated, array_to_string(w[1:512], ' ') AS kept FROM words""",
)
def token_truncate(spark, sf_dir):
    """Model input length: the first 512 tokens of each cleaned text."""
    cleaned = clean_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    words = F.size(tokens(F.col("cleaned")))
    return cleaned.select(
        "doc_id",
        words.alias("n_tokens"),
        (words > 512).alias("truncated"),
        F.array_join(token_window(F.col("cleaned")), " ").alias("kept"),
    )
