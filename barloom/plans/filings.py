"""Registered queries over headlines, filings, transcripts and lexicon scores, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import filings
from barloom.plans.registry import Registry
from barloom.sources import tables

R = Registry()
#: Headlines for the texts of the tables, which are invented words: a document's is chosen by its id.
HEADS = [
    "Firm beats estimates in quarterly results", "Group raises guidance for the year", "Maker to acquire rival in all-stock deal", "Start-up files for IPO", "Owner plans spin-off of its port", "Bank names new CEO",
    "Chain elects new director", "Utility declares dividend", "SEC charges broker after lawsuit", "FDA approves pill after phase 3", "Shop launches new service", "Carrier signs contract", "Fitch downgrades issuer",
    "Analysts cut price target", "Insider buying shown on Form 4", "Outage hits supply chain", "Fed holds interest rate", "A day without news", "", "   ",
]
TAGS = ["Q3 results", "Price target", "Data breach", "M&A", "Weather", "Joint venture"]


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_WORDS = "list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'), lambda x: lower(x))"
#: A lexicon from the words of `benchmark`: a word's digest says what it stands for.
LEX = f"""lex AS (SELECT word, k = 0 OR k = 3 AS positive, k = 1 AS negative, k >= 2 AS uncertainty FROM (SELECT DISTINCT word, ('0x' || substr(md5(word), 1, 2))::INT % 4 AS k FROM (SELECT unnest({_WORDS}) AS word FROM benchmark)))"""
SCORES = f"""{LEX}, w AS (SELECT doc_id AS id, unnest({_WORDS}) AS word FROM documents),
n AS (SELECT id, count(*) AS words, count(*) FILTER (positive) AS positive, count(*) FILTER (negative) AS negative, count(*) FILTER (uncertainty) AS uncertainty FROM w LEFT JOIN lex USING (word) GROUP BY id),
scores AS (SELECT doc_id AS id, coalesce(words, 0) AS words, coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative, coalesce(uncertainty, 0) AS uncertainty, CASE WHEN coalesce(words, 0) > 0 THEN greatest(-1, least(1, (positive - negative) / words::DOUBLE)) ELSE 0.0 END AS score FROM documents LEFT JOIN n ON id = doc_id)"""


def lexicon(spark, d):  # noqa: ANN001, ANN201
    w = F.explode(F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]+)"), 1), F.lower)).alias("word")
    k = F.conv(F.substring(F.md5("word"), 1, 2), 16, 10).cast("int") % 4
    words = tables.read(spark, d, "benchmark").select(w).distinct()
    return words.select("word", ((k == 0) | (k == 3)).alias("positive"), (k == 1).alias("negative"), (k >= 2).alias("uncertainty"))


def scores(spark, d):  # noqa: ANN001, ANN201
    return filings.lexicon_scores(tables.read(spark, d, "documents"), "doc_id", "text", lexicon(spark, d))


@R.query(f"WITH {SCORES} SELECT id AS doc_id, * EXCLUDE (id) FROM scores", "score")
def article_sentiment(spark, d):  # noqa: ANN001, ANN201
    return scores(spark, d).withColumnRenamed("id", "doc_id")


_FIRST = "split_part(coalesce(text, ''), chr(10), 1)"
HEADLINES = f"""heads AS (SELECT doc_id AS id, source, {_sql_list(HEADS)}[doc_id % {len(HEADS)} + 1] || chr(10) || CASE WHEN doc_id % {len(HEADS)} < {len(HEADS) - 2} THEN {_FIRST} ELSE '' END AS text, [{_sql_list(TAGS)}[doc_id % {len(TAGS)} + 1], source] AS tags FROM documents)"""
_LITERAL = lambda s: "'" + s.replace("'", "''") + "'"
EVENTS = f"""{HEADLINES}, ev AS (SELECT id, text, unnest(list_filter([{', '.join("CASE WHEN " + " OR ".join([f"contains(lower(array_to_string(tags, ' ')), {_LITERAL(w)})" for w in words] + [f"regexp_matches(text, {_LITERAL('(?i)' + pattern)})"]) + f" THEN '{c}' END" for c, words, pattern in filings.EVENT_RULES)}], lambda x: x IS NOT NULL)) AS category FROM heads WHERE trim(text, ' ' || chr(10)) <> ''),
flags AS (SELECT id, category, coalesce(nullif(trim(split_part(text, chr(10), 1)), ''), text) AS description, {filings.SEVERITY}::DOUBLE AS severity FROM ev)"""


def headlines(spark, d):  # noqa: ANN001, ANN201
    n = F.col("doc_id") % len(HEADS)
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (n + 1).cast("int"))
    body = F.when(n < len(HEADS) - 2, F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)).otherwise("")
    tag = F.element_at(F.array(*[F.lit(t) for t in TAGS]), (F.col("doc_id") % len(TAGS) + 1).cast("int"))
    return tables.read(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.concat(head, F.lit("\n"), body).alias("text"), F.array(tag, "source").alias("tags"))


def events(spark, d):  # noqa: ANN001, ANN201
    return filings.event_rules(headlines(spark, d).where(F.trim(F.translate("text", "\n", "")) != ""), "id", "text", "tags")


@R.query(f"WITH {EVENTS} SELECT id AS doc_id, * EXCLUDE (id) FROM flags", "severity")
def article_events(spark, d):  # noqa: ANN001, ANN201
    return events(spark, d).withColumnRenamed("id", "doc_id")


_FILED = r"""filed AS (SELECT page_id, '<p>Annual report</p>' || CASE WHEN page_id % 4 > 0 THEN '<h2>Item 1. Business</h2>' ELSE '<h2>BUSINESS</h2>' END || substr(html, 1, 1500) || '<h2>Item 1A. Risk Factors</h2><p>' || url || '</p>' || html
 || CASE WHEN page_id % 3 = 0 THEN '<h2>Item 7. Management''s Discussion and Analysis</h2>' || html ELSE '<h2>Item 7. Other matters</h2>' END || '<p>Item 9B. Other</p>' AS html FROM pages),
a AS (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS t FROM filed), b AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g') AS t FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', chr(10), 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&') AS t FROM b),
lines AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[ \t\n\r\f]*\n[ \t\n\r\f]*', chr(10), 'g'), '^\n|\n$', '', 'g')) AS t FROM c)"""


def _filed(spark, d):  # noqa: ANN001, ANN202
    html = F.expr("""concat('<p>Annual report</p>', CASE WHEN page_id % 4 > 0 THEN '<h2>Item 1. Business</h2>' ELSE '<h2>BUSINESS</h2>' END, substr(html, 1, 1500), '<h2>Item 1A. Risk Factors</h2><p>', url, '</p>', html,
 CASE WHEN page_id % 3 = 0 THEN concat('<h2>Item 7. Management''s Discussion and Analysis</h2>', html) ELSE '<h2>Item 7. Other matters</h2>' END, '<p>Item 9B. Other</p>')""")
    return tables.read(spark, d, "pages").select("page_id", html.alias("html"))


@R.query(f"WITH {_FILED} SELECT page_id, md5(t) AS text_md5, length(t) AS chars FROM lines")
def page_texts(spark, d):  # noqa: ANN001, ANN201
    t = _filed(spark, d).select("page_id", filings.page_lines("html").alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("chars"))


def _section_sql() -> str:
    one = []
    for n in filings.SECTIONS:
        q = n.replace("'", "''")
        one.append(rf"SELECT page_id, '{q}' AS name, trim(substr(trim(regexp_extract(t, '(?s)((?i:(?:Item\s+\d+[A-Z]?\.?\s*)?{q}).*?)(?:\nItem\s+\d+[A-Z]?\.?\s+[A-Z]|\z)', 1)), 1, 50000)) AS body FROM lines")
    return f"WITH {_FILED}, s AS ({' UNION ALL '.join(one)}) SELECT page_id, name, md5(body) AS body_md5, length(body) AS chars FROM s WHERE length(body) > 200"


@R.query(_section_sql())
def filing_sections(spark, d):  # noqa: ANN001, ANN201
    t = _filed(spark, d).select("page_id", filings.page_lines("html").alias("lines"))
    s = t.select("page_id", F.explode(filings.sections("lines")).alias("s"))
    return s.select("page_id", "s.name", F.md5("s.body").alias("body_md5"), F.length("s.body").cast("long").alias("chars"))


_ITEM_LIST = ["1.01", "2.02", "9.01", "5.02", "8.01", "10.1"]


@R.query(f"""WITH t AS (SELECT doc_id, 'Report. ITEM ' || {_sql_list(_ITEM_LIST)}[doc_id % 6 + 1] || ' and ' || CASE WHEN doc_id % 5 < 3 THEN 'Item  ' ELSE 'item' END || {_sql_list(_ITEM_LIST)}[doc_id % 5 + 1] || ' ' || {_FIRST} AS t FROM documents)
SELECT doc_id, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(t, '(?i)Item\\s+{n.replace('.', '[.]')}') THEN {_LITERAL(f'Item {n}: {title}')} END" for n, title in filings.ITEMS.items())}], lambda x: x IS NOT NULL), '; ') AS items FROM t""")
def filing_items(spark, d):  # noqa: ANN001, ANN201
    pick = lambda n: F.element_at(F.array(*[F.lit(x) for x in _ITEM_LIST]), (F.col("doc_id") % n + 1).cast("int"))
    t = F.concat(F.lit("Report. ITEM "), pick(6), F.lit(" and "), F.when(F.col("doc_id") % 5 < 3, "Item  ").otherwise("item"), pick(5), F.lit(" "), F.substring_index(F.coalesce("text", F.lit("")), "\n", 1))
    docs = tables.read(spark, d, "documents").select("doc_id", t.alias("t"))
    return docs.select("doc_id", F.array_join(filings.reported_items("t"), "; ").alias("items"))


@R.query(r"""WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'Executive' WHEN turn > 2 AND turn % 3 = 0 THEN 'analyst' WHEN role = 'system' THEN NULL ELSE 'operator' END AS role, role AS name, text FROM conversations WHERE coalesce(text, '') <> ''),
f AS (SELECT conv_id, min(turn) FILTER (lower(coalesce(role, '')) = 'analyst' OR coalesce(role, '') = '' AND contains(text, '?')) AS q FROM t GROUP BY ALL),
l AS (SELECT conv_id, CASE WHEN turn >= q THEN 'qa_session' ELSE 'prepared_remarks' END AS section, turn, '**' || coalesce(name, '') || '**' || CASE WHEN coalesce(role, '') <> '' THEN ' (' || lower(role) || ')' ELSE '' END || ': ' || text AS line FROM t JOIN f USING (conv_id)),
s AS (SELECT conv_id, section, substr(string_agg(line, chr(10) || chr(10) ORDER BY turn), 1, 60000) AS body FROM l GROUP BY ALL)
SELECT conv_id, section, md5(body) AS body_md5, length(body) AS chars FROM s WHERE length(body) > 100""")
def call_sections(spark, d):  # noqa: ANN001, ANN201
    role = F.when(F.col("role") == "assistant", "Executive").when((F.col("turn") > 2) & (F.col("turn") % 3 == 0), "analyst").when(F.col("role") == "system", F.lit(None)).otherwise("operator")
    turns = tables.read(spark, d, "conversations").select("conv_id", "turn", role.alias("role"), F.col("role").alias("name"), "text")
    s = filings.speakers(turns, ["analyst"], [""])
    return s.select("conv_id", "section", F.md5("body").alias("body_md5"), F.length("body").cast("long").alias("chars"))
