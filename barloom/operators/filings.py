"""Filings, headlines and transcripts as text: lexicon scores, event rules, page text, sections, items, speakers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event categories in their order, the words sought in tags, and the pattern sought in text (matched without regard to case).
EVENT_RULES: list[tuple[str, list[str], str | None]] = [
    ("earnings_release", ["earnings", "results", "quarter", "q1", "q2", "q3", "q4", "fy20", "fy21", "fy22", "fy23", "fy24", "fy25", "fy26"], r"\bearnings\b|\bbeats?\s+(?:expect|estimat)|\bmisses?\s+(?:expect|estimat)|\bquarterly results\b"),
    ("earnings_guidance", ["guidance", "outlook", "forecast", "raises guidance", "lowers guidance", "withdraws guidance"], r"\b(?:raises|lowers|withdraws|updates?|reaffirms?)\s+(?:guidance|outlook|forecast)\b"),
    ("merger_or_acquisition", ["merger", "acquisition", "acquire", "acquires", "buyout", "takeover", "m&a", "consolidation"], r"\b(?:acquir(?:es?|er|ing|ed|ition)|merging with|to (?:buy|acquire)|merger|takeover|buyout|all-stock deal)\b"),
    ("ipo_or_secondary", ["ipo", "initial public offering", "secondary offering", "direct listing", "spac"], r"\bIPO\b|\binitial public offering\b|\bsecondary offering\b|\bdirect listing\b"),
    ("spinoff_or_divestiture", ["spinoff", "spin-off", "divestiture", "carveout", "carve-out"], r"\bspin-?off\b|\bdivestiture\b|\bcarve-?out\b"),
    ("management_change", ["ceo", "cfo", "coo", "executive", "resignation", "appointment", "stepping down", "successor"], r"\b(?:names?|appoints?|hires?)\s+new\s+(?:CEO|CFO|COO|chief)|\b(?:CEO|CFO|COO)\s+(?:steps? down|resigns?|to (?:resign|retire))"),
    ("board_change", ["board", "director", "chairman", "chairwoman"], r"\b(?:names?|appoints?|elects?)\s+(?:new\s+)?(?:director|board member|chairman|chairwoman)"),
    ("buyback_or_dividend", ["buyback", "repurchase", "dividend", "capital return"], r"\b(?:share buyback|repurchase program|declares? dividend|raises? dividend|special dividend)\b"),
    ("regulatory_action", ["sec", "doj", "cftc", "ftc", "regulator", "lawsuit", "investigation", "subpoena", "fine", "settlement"], r"\bSEC (?:probe|investigation|charges|settles)\b|\bDOJ (?:probe|investigation|charges)\b|\b(?:sued|lawsuit|class action|settlement)\b|\bsubpoena"),
    ("fda_action", ["fda", "drug approval", "clinical trial", "recall", "adverse event", "phase 1", "phase 2", "phase 3", "phase iii"], r"\bFDA (?:approves?|denies?|rejects?|grants?)\b|\bclinical trial\b|\bphase \d\b|\brecalls?\b"),
    ("product_launch", ["launch", "unveils", "introduces", "release", "rollout"], r"\b(?:launches?|unveils?|introduces?|debuts?)\s+(?:new\s+)?(?:product|service|platform|feature|tool|version)\b"),
    ("partnership_or_contract", ["partnership", "contract", "deal", "agreement", "joint venture", "jv", "collaboration"], r"\b(?:partners?|partnership)\s+with\b|\bjoint venture\b|\bsigns?\s+(?:agreement|contract|deal)\b"),
    ("credit_rating_change", ["credit rating", "moody's", "s&p global", "fitch", "downgrade", "upgrade"], r"\b(?:Moody'?s|S&P Global|Fitch)\s+(?:downgrades?|upgrades?|cuts?|raises?)\b|\bcredit rating\b"),
    ("analyst_action", ["analyst", "price target", "rating", "upgraded", "downgraded", "initiated coverage"], r"\banalysts?\s+(?:upgrade|downgrade|cut|raise|initiate)\b|\bprice target\b|\b(?:upgraded|downgraded)\s+(?:to|from)\b"),
    ("insider_transaction", ["insider", "10b5-1", "form 4", "insider buying", "insider selling"], r"\binsider (?:buying|selling|sale)\b|\b10b5-1\b|\bForm 4\b"),
    ("macro_or_sector", ["sector", "macro", "industry", "economy", "fed", "interest rate", "inflation", "gdp"], r"\b(?:sector|industry|macro|economy|Fed|inflation|GDP|interest rate)\b"),
    ("operational_disruption", ["outage", "cyberattack", "breach", "supply chain", "disruption", "shortage"], r"\b(?:outage|cyber\s*attack|data breach|supply chain)\b"),
]
SEVERITY = 0.5
# Sections of annual and quarterly reports, and the items of a current report.
SECTIONS = ["Risk Factors", "Management's Discussion and Analysis", "Business", "Quantitative and Qualitative Disclosures About Market Risk"]
ITEMS = {
    "1.01": "Entry into a Material Definitive Agreement", "1.02": "Termination of a Material Definitive Agreement", "2.01": "Completion of Acquisition or Disposition of Assets",
    "2.02": "Results of Operations and Financial Condition", "2.05": "Costs Associated with Exit or Disposal Activities", "2.06": "Material Impairments",
    "4.01": "Changes in Registrant's Certifying Accountant", "4.02": "Non-Reliance on Previously Issued Financial Statements", "5.02": "Departure/Election of Directors or Principal Officers",
    "7.01": "Regulation FD Disclosure", "8.01": "Other Events",
}


def lexicon_scores(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, clip: float = 1.0) -> DataFrame:
    """id, words, positive, negative, uncertainty, score: (positive - negative) / words, within +-clip, 0 without words.

    Words are runs of A-Z in lower case. The lexicon (word, positive, negative, uncertainty) is a table: Spark sends it to the tasks if it
    is small, so that a text's words are counted where they are read, and joins it by word otherwise."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit("([A-Za-z]+)"), 1), F.lower)
    long = docs.select(F.col(id_col).alias("id"), F.explode_outer(words).alias("word")).join(lexicon, "word", "left")
    n = lambda c: F.count(F.when(F.col(c), 1)).alias(c)
    g = long.groupBy("id").agg(F.count("word").alias("words"), n("positive"), n("negative"), n("uncertainty"))
    raw = (F.col("positive") - F.col("negative")) / F.col("words")
    return g.withColumn("score", F.when(F.col("words") > 0, F.greatest(F.lit(-clip), F.least(F.lit(clip), raw))).otherwise(0.0))


def event_rules(docs: DataFrame, id_col: str, text_col: str, tags_col: str, rules: list[tuple[str, list[str], str | None]] | None = None) -> DataFrame:
    """id, category, description, severity for each category that a tag's word or the text's pattern gives; nothing for blank texts.

    All rules are columns of one projection, so a text is read once and nothing is joined; the description is its first line."""
    text = F.coalesce(text_col, F.lit(""))
    blob = F.lower(F.array_join(F.coalesce(tags_col, F.array().cast("array<string>")), " "))
    found = []
    for category, words, pattern in rules or EVENT_RULES:
        hit = F.lit(False)
        for w in words:
            hit = hit | blob.contains(w)
        found.append(F.when(hit | (text.rlike(f"(?i){pattern}") if pattern else F.lit(False)), F.lit(category)))
    first = F.trim(F.substring_index(text, "\n", 1))
    rows = docs.where(F.trim(text) != "").select(F.col(id_col).alias("id"), F.explode(F.array_compact(F.array(*found))).alias("category"), F.coalesce(F.nullif(first, F.lit("")), text).alias("description"))
    return rows.withColumn("severity", F.lit(SEVERITY))


def page_lines(html: str) -> Column:
    """The text nodes of a page, each on a line of its own: no comments, scripts, styles or tags, the five common entities decoded."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    for tag in ("script", "style"):
        t = F.regexp_replace(t, rf"(?is)<{tag}[^>]*>.*?</{tag}>", "")
    t = F.regexp_replace(t, r"<[^>]*>", "\n")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t\n\r\f]*\n[ \t\n\r\f]*", "\n"), r"^\n|\n$", ""))


def sections(lines: str, names: list[str] = SECTIONS, limit: int = 50_000, least: int = 200) -> Column:
    """name -> what stands from a section's heading, with the item number before it, to the next item; cut to the limit, left out if no longer than the least."""
    found = []
    for name in names:
        head = r"(?:Item\s+\d+[A-Z]?\.?\s*)?" + name
        body = F.trim(F.substring(F.trim(F.regexp_extract(F.col(lines), rf"(?s)((?i:{head}).*?)(?:\nItem\s+\d+[A-Z]?\.?\s+[A-Z]|\z)", 1)), 1, limit))
        found.append(F.when(F.length(body) > least, F.struct(F.lit(name).alias("name"), body.alias("body"))))
    return F.array_compact(F.array(*found))


def reported_items(text: str, items: dict[str, str] | None = None) -> Column:
    """The items that a report names, in their order, as `Item 1.01: its title`."""
    return F.array_compact(F.array(*[F.when(F.coalesce(text, F.lit("")).rlike(rf"(?i)Item\s+{n.replace('.', '[.]')}"), F.lit(f"Item {n}: {t}")) for n, t in (items or ITEMS).items()]))


def speakers(turns: DataFrame, analysts: list[str], others: list[str], limit: int = 60_000, least: int = 100) -> DataFrame:
    """conv_id, section (prepared_remarks, qa_session), body: spoken turns before and from the first question on.

    A question is any turn of an analyst, or one of the others (roles) with a question mark. turns: conv_id, turn, role, name, text. Sections of no more than the
    least length go. A conversation is gathered for its text, as it is one row of the result."""
    role = F.lower(F.coalesce("role", F.lit("")))
    said = turns.where(F.coalesce("text", F.lit("")) != "")
    asks = role.isin(analysts) | (role.isin(others) & F.contains(F.col("text"), F.lit("?")))
    first = said.groupBy("conv_id").agg(F.min(F.when(asks, F.col("turn"))).alias("_from"))
    line = F.when(role != "", F.concat(F.lit("**"), F.coalesce("name", F.lit("")), F.lit("** ("), role, F.lit("): "), F.col("text"))).otherwise(F.concat(F.lit("**"), F.coalesce("name", F.lit("")), F.lit("**: "), F.col("text")))
    df = said.join(first, "conv_id").withColumn("section", F.when(F.col("turn") >= F.col("_from"), "qa_session").otherwise("prepared_remarks"))
    g = df.groupBy("conv_id", "section").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("_l"))
    g = g.select("conv_id", "section", F.substring(F.array_join(F.transform("_l", lambda s: s["line"]), "\n\n"), 1, limit).alias("body"))
    return g.where(F.length("body") > least)
