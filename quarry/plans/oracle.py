"""DuckDB oracle SQL for the registered queries.

Views ``documents labels benchmark pages conversations events embeddings
orders ...`` are registered by the checker. Every fixture view of
``fixtures.py`` has a CTE twin here, and each query's SQL is the fixture CTE
plus the operator written as plain SQL (windows where Spark uses the
partition-offset index, since a single-node engine has no skew to avoid).
Regex classes are spelled the same way as in ``quarry.functions``.
"""

from __future__ import annotations

from quarry.functions.text import (ASCII_PUNCTUATION, PY_LINE_BREAK, PY_WHITESPACE,
                                   PY_WHITESPACE_CHARS, URL_PATTERN)
from quarry.functions.web import NETLOC_PATTERN, SCHEME_PATTERN

WS = f"[{PY_WHITESPACE}]"
NON_WS = f"[^{PY_WHITESPACE}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def has_text(col: str) -> str:
    return f"({col} IS NOT NULL AND regexp_matches({col}, {q(NON_WS)}))"


WS_CHARS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE_CHARS) + ")"


def py_strip(col: str) -> str:
    return f"trim({col}, {WS_CHARS_SQL})"


def py_rstrip(col: str) -> str:
    return f"rtrim({col}, {WS_CHARS_SQL})"


def simple_clean(col: str) -> str:
    return py_strip(f"translate(lower(coalesce(CAST({col} AS VARCHAR), '')), chr(10) || chr(9), '  ')")


def raw_stance(quality="quality", toxic="toxic") -> str:
    return (f"CASE WHEN {quality}=1 AND {toxic}=0 THEN 'agree' WHEN {quality}=1 AND {toxic}=1 "
            f"THEN 'discuss' WHEN {quality}=0 AND {toxic}=0 THEN 'disagree' "
            f"WHEN {quality}=0 AND {toxic}=1 THEN 'unrelated' END")


def case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def in_list(col: str, keys) -> str:
    return f"{col} IN ({', '.join(q(k) for k in keys)})"


NB = "(SELECT count(*) FROM benchmark)"
NPAGES = "(SELECT count(*) FROM pages)"

def _names(loose: bool) -> str:
    """HTML's named references (from the standard library's table) as a SQL map."""
    from html.entities import html5
    kept = {k: v for k, v in html5.items() if not (loose and k.endswith(";"))}
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in kept.items()) + "}"


def _number(n: str) -> str:
    """The character of a numeric reference: HTML's replacements of control characters, no surrogates, no non-characters."""
    from html import unescape
    special = {n: unescape(f"&#{n};") for n in range(160) if unescape(f"&#{n};") != chr(n)}
    cases = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in special.items())
    return (f"CASE WHEN {n} IS NULL OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"WHEN {n} BETWEEN 64976 AND 65007 OR {n} % 65536 >= 65534 THEN '' ELSE CASE {n} {cases} ELSE chr(CAST({n} AS INTEGER)) END END")


def unescape_sql(text: str) -> str:
    """References decoded piece by piece: the text is split at "&", the reference at a
    piece's beginning is looked up (the longest name that fits) and spliced."""
    decimal, hexadecimal = "^#([0-9]+);?", "^#[xX]([0-9a-fA-F]+);?"
    name = r"regexp_extract(p, '^[^\t\n\f <&#;]{1,32};?')"
    digits = f"ltrim(regexp_extract(p, '{decimal}', 1), '0')"
    hexes = f"ltrim(lower(regexp_extract(p, '{hexadecimal}', 1)), '0')"
    ten = f"CASE WHEN length({digits}) <= 9 THEN CAST('0' || {digits} AS BIGINT) END"
    sixteen = (f"CASE WHEN length({hexes}) <= 7 THEN list_reduce(list_prepend(0, list_transform(range(1, length({hexes}) + 1), "
               f"lambda i: instr('0123456789abcdef', substr({hexes}, i, 1)) - 1)), lambda x, y: 16 * x + y) END")
    begun = ", ".join(f"CASE WHEN length({name}) > {n} THEN loose[substr(p, 1, {n})] || substr(p, {n + 1}) END" for n in range(6, 1, -1))
    return f"""array_to_string(list_prepend(string_split({text}, '&')[1], list_transform(string_split({text}, '&')[2:], lambda p:
      CASE WHEN regexp_matches(p, '{decimal}') THEN {_number(ten)} || substr(p, length(regexp_extract(p, '{decimal}')) + 1)
           WHEN regexp_matches(p, '{hexadecimal}') THEN {_number(sixteen)} || substr(p, length(regexp_extract(p, '{hexadecimal}')) + 1)
           ELSE coalesce(names[{name}] || substr(p, length({name}) + 1), {begun}, '&' || p) END)), '')"""


#: Pages with the decoded text of their first title.
TITLED_PAGES = f"""refs AS (SELECT {_names(False)} AS names, {_names(True)} AS loose),
found_titles AS (SELECT page_id, url, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS found FROM pages),
titled_pages AS (SELECT page_id, url, html, {unescape_sql('found')} AS raw FROM found_titles, refs)"""


def headline_media(raw: str) -> tuple[str, str]:
    """Headline and medium of a title: cut at its last "-", "|" or dash."""
    last = r"'(?s)^(.*)[-|\x{2014}]([^-|\x{2014}]*)$'"
    sep = f"regexp_matches({raw}, '[-|\\x{{2014}}]')"
    headline = (f"CASE WHEN {raw} = '' THEN 'Page not found' WHEN {sep} THEN "
                f"{py_strip(f'regexp_extract({raw}, {last}, 1)')} ELSE {raw} END")
    media = (f"CASE WHEN {raw} = '' THEN 'Media not found' WHEN {sep} THEN "
             f"regexp_extract({raw}, {last}, 2) ELSE 'Media not found' END")
    return headline, media


def home_url(url: str) -> str:
    return (f"lower(regexp_extract({url}, {q(SCHEME_PATTERN)}, 1)) || '://' || "
            f"regexp_extract({url}, {q(NETLOC_PATTERN)}, 1) || '/'")


# --- fixture CTEs -------------------------------------------------------------------

FX_STANCE_ROWS = f"""fx_stance_rows AS (
  SELECT l.doc_id, b.text AS headline, l.doc_id AS body_id, {raw_stance('l.quality', 'l.toxic')} AS stance
  FROM labels l JOIN benchmark b ON b.item_id = l.doc_id % {NB})"""

FX_STANCE_BODIES = """fx_stance_bodies AS (SELECT doc_id AS body_id, text AS body FROM documents)"""

FX_STANCE_PAIRS = f"""fx_stance_pairs AS (
  SELECT d.doc_id, d.text AS body, b.text AS headline, {raw_stance('l.quality', 'l.toxic')} AS raw_stance
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN benchmark b ON b.item_id = d.doc_id % {NB})"""

FX_PAIRS_BLANK = FX_STANCE_PAIRS + """,
fx_pairs_blank AS (
  SELECT doc_id AS idx,
    CASE WHEN doc_id % 7 = 0 THEN '  ' ELSE body END AS source,
    CASE WHEN doc_id % 13 = 0 THEN '' ELSE headline END AS target,
    coalesce(raw_stance, 'none') || '  ' AS label
  FROM fx_stance_pairs)"""


def thread_label(conv: str, turn: str) -> str:
    h = f"(({conv}) * 7 + ({turn}) * 3)"
    return (f"CASE WHEN {h} % 11 = 10 THEN NULL WHEN {h} % 6 IN (0, 1, 4) THEN 'support' "
            f"WHEN {h} % 6 IN (2, 3) THEN 'deny' ELSE 'comment' END")


FX_THREADS = f"""fx_thread_posts AS (
  SELECT conv_id AS thread, turn AS post, text, turn = 0 AS is_source FROM conversations),
fx_thread_edges AS (
  SELECT conv_id AS thread, CAST(floor((turn - 1) / 2) AS BIGINT) AS parent, turn AS node
  FROM conversations WHERE turn > 0),
fx_thread_labels AS (
  SELECT * FROM (SELECT conv_id AS thread, turn AS post, {thread_label('conv_id', 'turn')} AS label
                 FROM conversations) WHERE label IS NOT NULL)"""

FX_THREAD_DEV_LABELS = f"""fx_thread_dev_labels AS (
  SELECT * FROM (SELECT conv_id AS thread, turn AS post, {thread_label('conv_id', 'turn + 1')} AS label
                 FROM conversations WHERE turn % 3 = 0) WHERE label IS NOT NULL)"""

_H, _M = headline_media("raw")
FX_PAGE_HEADLINES = TITLED_PAGES + f""",
fx_page_headlines AS (
  SELECT page_id AS url_id, url AS full_url, {_H} AS headline, {_M} AS media, '1' AS clean FROM titled_pages)"""

FX_THREAD_MANIFEST = f"""fx_thread_manifest AS (
  SELECT c.conv_id AS thread, p.page_id AS url_id, '' AS short_url, p.url AS full_url
  FROM conversations c JOIN pages p ON p.page_id = c.conv_id % {NPAGES} WHERE c.turn = 0)"""

FX_MENTIONS = """fx_mentions AS (
  SELECT CASE WHEN page_id % (SELECT count(*) // 10 + 10 FROM pages) % 20 < 11 THEN 'fake' ELSE 'real' END AS news_label,
         CAST(page_id % (SELECT count(*) // 10 + 10 FROM pages) AS BIGINT) AS news_id, page_id AS post_id, url AS expanded_url
  FROM pages)"""

_AH, _ = headline_media("p.raw")
FX_ARTICLES = TITLED_PAGES + f""",
fx_first_page AS (
  SELECT * FROM (SELECT page_id % (SELECT count(*) // 10 + 10 FROM pages) AS news_id, url, raw,
                        row_number() OVER (PARTITION BY page_id % (SELECT count(*) // 10 + 10 FROM pages) ORDER BY page_id) AS rn FROM titled_pages)
  WHERE rn = 1),
fx_articles AS (
  SELECT CASE WHEN p.news_id % 20 < 11 THEN 'fake' ELSE 'real' END AS news_label,
         CAST(p.news_id AS BIGINT) AS news_id, p.url, {_AH} AS title,
         CASE WHEN p.news_id % 4 = 0 THEN '' ELSE coalesce(b.text, '') END AS description
  FROM fx_first_page p LEFT JOIN benchmark b ON b.item_id = p.news_id),
fx_article_posts AS (
  SELECT CAST(doc_id % (SELECT count(*) // 10 + 10 FROM pages) AS BIGINT) AS news_id, doc_id AS post_id, text AS post
  FROM documents)"""

FX_ANNOTATED = f"""fx_annotated AS (
  SELECT d.source AS batch, CASE WHEN d.doc_id % 2 = 0 THEN 'fake' ELSE 'real' END AS news_label,
         d.doc_id, d.text AS source, b.text AS target,
         (['support', 'deny', 'comment', 'report'])[CAST(d.doc_id % 4 + 1 AS INTEGER)] AS stance,
         CASE WHEN d.doc_id % 3 = 0 THEN 'negative' WHEN d.doc_id % 3 = 1 THEN 'neutral' END AS sentiment,
         CAST(CASE WHEN d.doc_id % 5 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS clean
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % {NB})"""

FX_PREDS = """fx_preds AS (
  SELECT e.event_id AS idx, e.event_type AS truth,
         CASE WHEN e.event_id % 3 = 0 AND n.event_type IS NOT NULL THEN n.event_type ELSE e.event_type END AS pred,
         CASE WHEN e.event_id % 5 = 0 THEN 'unrelated' ELSE 'related' END AS relation
  FROM events e LEFT JOIN events n ON n.event_id = e.event_id + 1)"""

FX_PARAPHRASE = f"""fx_paraphrase AS (
  SELECT d.doc_id, d.text AS sent1, b.text AS sent2,
         '(' || CAST(d.doc_id % 6 AS VARCHAR) || ', ' || CAST(5 - d.doc_id % 6 AS VARCHAR) || ')' AS raw_label
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % {NB})"""

FX_PAIR_ROWS = f"""fx_pair_rows AS (
  SELECT CAST(d1.doc_id % 2 AS VARCHAR) AS label, CAST(d1.doc_id AS VARCHAR) AS id1,
         CAST(d2.doc_id AS VARCHAR) AS id2,
         regexp_replace(d1.text, {q(WS + '+')}, ' ', 'g') AS s1,
         regexp_replace(d2.text, {q(WS + '+')}, ' ', 'g') AS s2
  FROM documents d1 JOIN documents d2 ON d2.doc_id = d1.doc_id + 1),
fx_dev_ids AS (
  SELECT CAST(doc_id AS VARCHAR) AS id1, CAST(doc_id + 1 AS VARCHAR) AS id2 FROM documents
  WHERE doc_id % 10 = 3)"""

FX_EVENT_LINES = """fx_event_rows AS (
  SELECT o_custkey AS event_id, CAST(o_custkey % 3 AS VARCHAR) AS label,
         list_sort(list(o_orderkey)) AS ids
  FROM orders GROUP BY o_custkey)"""

FX_LOGITS = f"""fx_logit_test AS (
  SELECT e.vec_id AS idx, d.text AS source, b.text AS target,
         (['support', 'deny', 'comment'])[CAST(e.label % 3 + 1 AS INTEGER)] AS stance
  FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id % (SELECT count(*) FROM documents)
  JOIN benchmark b ON b.item_id = e.vec_id % {NB}),
fx_logit_models AS (
  SELECT vec_id AS idx,
         CAST(embedding[1:3] AS DOUBLE[]) AS la, CAST(embedding[4:6] AS DOUBLE[]) AS lb
  FROM embeddings)"""

_UH, _ = headline_media("raw")
FX_URL_TEXT = TITLED_PAGES + f""",
fx_url_text AS (
  SELECT page_id, 'see ' || url || ' via ' || {_UH} AS text FROM titled_pages)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- shared pipeline fragments ---------------------------------------------------------

def split_sql(src: str, idx: str = "idx", label: str = "stance", text_cols=("source", "target"),
              cols=("idx", "source", "target", "stance"), k: int = 10) -> str:
    """F01 -> V08 -> W02 -> W01 over relation ``src`` (a CTE name)."""
    keep = " AND ".join(has_text(c) for c in text_cols)
    sel = ", ".join(c if c != label else f"{py_rstrip(label)} AS {label}" for c in cols)
    return f"""split_kept AS (SELECT {sel} FROM {src} WHERE {keep}),
split_ord AS (
  SELECT *, row_number() OVER (ORDER BY md5('9-' || CAST({idx} AS VARCHAR))) - 1 AS p,
         count(*) OVER () AS n FROM split_kept),
split_out AS (
  SELECT *, p < ceil(0.05e0 * n) AS is_test FROM split_ord),
split_final AS (
  SELECT {', '.join(cols)}, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split,
         CAST(CASE WHEN is_test THEN NULL ELSE ntile({k}) OVER (PARTITION BY is_test ORDER BY p) END AS BIGINT) AS fold
  FROM split_out)"""


STANCE_PAIRS = with_(FX_STANCE_ROWS, FX_STANCE_BODIES, f"""mapped AS (
  SELECT doc_id, headline, body_id, {case_map('stance', {'agree': 'support', 'disagree': 'deny', 'discuss': 'comment', 'unrelated': 'unrelated'})} AS label
  FROM fx_stance_rows WHERE {in_list('stance', ['agree', 'disagree', 'discuss', 'unrelated'])}),
pairs AS (
  SELECT m.doc_id, replace(b.body, chr(10), ' ') AS source, m.headline AS target, m.label
  FROM mapped m JOIN fx_stance_bodies b ON b.body_id = m.body_id)""")


def pipeline_stance_sql() -> str:
    return STANCE_PAIRS.rstrip() + ",\n" + f"""indexed AS (
  SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS idx, source, target, label AS stance
  FROM pairs),
{split_sql('indexed')}
SELECT * FROM split_final"""


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {"pipeline_stance": pipeline_stance_sql()}
    out.update(_more_queries())
    out.update(_file_and_pipeline_queries())
    return out


ARTICLE = {'agree': 'support', 'disagree': 'deny', 'discuss': 'comment', 'unrelated': 'unrelated'}
RELATION = {'agree': 'related', 'disagree': 'related', 'discuss': 'related', 'unrelated': 'unrelated'}
RUMOUR = {'support': 'support', 'deny': 'deny', 'comment': 'comment'}
PARAPHRASE = {"(3, 2)": "paraphrases", "(4, 1)": "paraphrases", "(5, 0)": "paraphrases",
              "(1, 4)": "non_paraphrases", "(0, 5)": "non_paraphrases", "(2, 3)": "debatable"}
STANCE_DOMAIN = ["support", "deny", "comment", "unrelated"]


def stance_pairs_sql(mapping=ARTICLE) -> str:
    return with_(FX_STANCE_ROWS, FX_STANCE_BODIES, f"""mapped AS (
  SELECT doc_id, headline, body_id, {case_map('stance', mapping)} AS label
  FROM fx_stance_rows WHERE {in_list('stance', list(mapping))}),
joined AS (
  SELECT m.doc_id, b.body AS raw_source, m.headline AS target, m.label
  FROM mapped m JOIN fx_stance_bodies b ON b.body_id = m.body_id),
pairs AS (SELECT doc_id, replace(raw_source, chr(10), ' ') AS source, target, label FROM joined)""")


def paragraphs_sql(src: str, text: str = "source") -> str:
    """C10 over relation ``src`` with columns doc_id, <text>, target[, label]."""
    return f"""para_split AS (
  SELECT *, regexp_split_to_array({text}, {q(PY_LINE_BREAK)}) AS parts FROM {src}),
para_rows AS (
  SELECT * EXCLUDE (parts, {text}), unnest(parts) AS {text},
         CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS para
  FROM para_split),
paragraphs AS (SELECT * FROM para_rows WHERE {has_text(text)})"""


def cross_eval_sql(src: str, order: str, k: int = 10, idx: str | None = None) -> str:
    idx_expr = idx if idx else f"row_number() OVER (ORDER BY {order})"
    return f"""SELECT CAST({idx_expr} AS BIGINT) AS idx, source, target, stance,
       CAST(ntile({k}) OVER (ORDER BY {order}) AS BIGINT) AS fold FROM {src}"""


def thread_inputs(heads_filter: str = "TRUE") -> str:
    return with_(FX_THREADS, FX_PAGE_HEADLINES, FX_THREAD_MANIFEST, f"""posts AS (
  SELECT * FROM fx_thread_posts WHERE {has_text('text')}),
headline_table AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_id ORDER BY url_id DESC) AS rn
                 FROM fx_page_headlines WHERE clean = '1') WHERE rn = 1),
heads AS (SELECT m.thread, h.headline FROM fx_thread_manifest m JOIN headline_table h ON h.url_id = m.url_id
          WHERE {heads_filter}),
j03 AS (
  SELECT e.thread, e.parent, e.node, n.text AS source, p.text AS target, l.label
  FROM fx_thread_edges e JOIN posts p ON p.thread = e.thread AND p.post = e.parent
  JOIN posts n ON n.thread = e.thread AND n.post = e.node
  JOIN fx_thread_labels l ON l.thread = e.thread AND l.post = e.node
  WHERE {in_list('l.label', list(RUMOUR))}),
seeded AS (
  SELECT s.thread, s.post, s.text, l.label FROM posts s
  JOIN fx_thread_labels l ON l.thread = s.thread AND l.post = s.post
  WHERE s.is_source AND {in_list('l.label', list(RUMOUR))}
    AND s.thread IN (SELECT thread FROM heads)),
j04 AS (
  SELECT s.thread, s.post, s.text AS source, h.headline AS target, s.label
  FROM seeded s JOIN heads h ON h.thread = s.thread)""")


THREAD_INPUTS = thread_inputs()

J05_SQL = """, prop AS (
  WITH RECURSIVE walk(thread, node, bit) AS (
    SELECT thread, post, CASE WHEN label = 'deny' THEN 1 ELSE 0 END FROM seeded
    WHERE label IN ('support', 'deny')
    UNION ALL
    SELECT e.thread, e.node, (w.bit + CASE WHEN l.label = 'deny' THEN 1 ELSE 0 END) % 2
    FROM walk w JOIN fx_thread_edges e ON e.thread = w.thread AND e.parent = w.node
    JOIN posts n ON n.thread = e.thread AND n.post = e.node
    JOIN fx_thread_labels l ON l.thread = e.thread AND l.post = e.node
    WHERE l.label IN ('support', 'deny'))
  SELECT * FROM walk),
j05 AS (
  SELECT p.thread, p.node, n.text AS source, h.headline AS target,
         CASE WHEN p.bit = 0 THEN 'support' ELSE 'deny' END AS label
  FROM prop p JOIN fx_thread_edges e ON e.thread = p.thread AND e.node = p.node
  JOIN posts n ON n.thread = p.thread AND n.post = p.node
  JOIN heads h ON h.thread = p.thread)
"""

PREDS = with_(FX_PREDS)

PER_LABEL = """cm AS (SELECT truth, pred, count(*) AS n FROM fx_preds GROUP BY truth, pred),
roles AS (
  SELECT truth AS label, n AS t, CASE WHEN truth = pred THEN n ELSE 0 END AS tp, 0 AS p FROM cm
  UNION ALL SELECT pred AS label, 0 AS t, 0 AS tp, n AS p FROM cm),
per AS (SELECT label, sum(t) AS support, sum(tp) AS tp, sum(p) AS predicted FROM roles GROUP BY label),
per_m AS (
  SELECT label, tp, support,
    CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) END AS prec,
    CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS rec,
    CASE WHEN predicted + support = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / CAST(predicted + support AS DOUBLE) END AS f
  FROM per),
overall AS (
  SELECT CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS acc,
         avg(prec) AS mp, avg(rec) AS mr, avg(f) AS mf FROM per_m)"""

EVENTS = with_(FX_EVENT_LINES, """events_parsed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, 'label:' || label AS label,
         list_transform(ids, lambda x: CAST(x AS VARCHAR)) AS post_ids FROM fx_event_rows)""")

PAIRS = with_(FX_PAIR_ROWS)

LOGIT_SOFTMAX = """sm AS (
  SELECT idx, la, lb,
         list_transform(la, lambda x: exp(x - list_max(la))) AS ea,
         list_transform(lb, lambda x: exp(x - list_max(lb))) AS eb FROM fx_logit_models)"""

ARTICLE_ROWS = with_(FX_ARTICLES, """posts AS (
  SELECT p.news_id, p.post_id, p.post, a.news_label FROM fx_article_posts p JOIN fx_articles a ON a.news_id = p.news_id)""")


def _more_queries() -> dict[str, str]:
    o: dict[str, str] = {}
    sp = stance_pairs_sql()
    o["pipeline_stance_paragraphs"] = sp.rstrip() + ",\n" + paragraphs_sql("pairs_raw") .replace(
        "para_split AS (", "para_split AS (") + "\n" if False else (
        stance_pairs_sql().rstrip() + ",\npairs_raw AS (SELECT doc_id, raw_source AS source, target, label AS stance FROM joined),\n"
        + paragraphs_sql("pairs_raw") + "\n" + cross_eval_sql("paragraphs", "doc_id, para"))
    o["pipeline_relation_paragraphs"] = (
        stance_pairs_sql(RELATION).rstrip() + ",\npairs_raw AS (SELECT doc_id, raw_source AS source, target, label AS stance FROM joined),\n"
        + paragraphs_sql("pairs_raw") + "\n" + cross_eval_sql("paragraphs", "doc_id, para"))
    o["pipeline_relation"] = (stance_pairs_sql(RELATION).rstrip() + ",\nst AS (SELECT doc_id, source, target, label AS stance FROM pairs)\n"
                              + cross_eval_sql("st", "doc_id"))
    o["pipeline_stance_full_folds"] = (sp.rstrip() + ",\nst AS (SELECT doc_id, source, target, label AS stance FROM pairs)\n"
                                       + cross_eval_sql("st", "doc_id"))
    o["pipeline_folds_from_table"] = (sp.rstrip() + ",\nst AS (SELECT doc_id, source, target, label AS stance FROM pairs)\n"
                                      + cross_eval_sql("st", "doc_id", idx="doc_id"))

    ann_stance = with_(FX_ANNOTATED, f"""a AS (
  SELECT batch, news_label, doc_id, {simple_clean('source')} AS source, {simple_clean('target')} AS target, stance
  FROM fx_annotated WHERE (stance IS NULL OR stance <> 'report') AND clean = 1),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY batch, news_label, doc_id) AS rk FROM a)
  WHERE rk = 1),
indexed AS (
  SELECT CAST(row_number() OVER (ORDER BY batch, news_label, doc_id) AS BIGINT) AS idx, source, target, stance FROM dedup)""")
    o["pipeline_annotated_stance"] = ann_stance.rstrip() + ",\n" + split_sql("indexed") + "\nSELECT * FROM split_final"
    ann_sent = with_(FX_ANNOTATED, f"""a AS (
  SELECT batch, news_label, doc_id, {simple_clean('source')} AS source, sentiment
  FROM fx_annotated WHERE clean = 1 AND stance = 'comment' AND sentiment IS NOT NULL AND sentiment <> ''),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY batch, news_label, doc_id) AS rk FROM a)
  WHERE rk = 1),
indexed AS (
  SELECT CAST(row_number() OVER (ORDER BY batch, news_label, doc_id) AS BIGINT) AS idx, source, sentiment FROM dedup)""")
    o["pipeline_annotated_sentiment"] = (ann_sent.rstrip() + ",\n" + split_sql(
        "indexed", label="sentiment", text_cols=("source",), cols=("idx", "source", "sentiment"))
        + "\nSELECT * FROM split_final")
    o["pipeline_sst"] = (ann_sent.rstrip() + ",\n" + split_sql(
        "indexed", label="sentiment", text_cols=("source",), cols=("idx", "source", "sentiment"))
        + "\nSELECT source AS sentence, " + case_map("sentiment", {"negative": 0, "neutral": 1})
        + " AS label FROM split_final")
    o["pipeline_rescale"] = pipeline_stance_sql().replace("SELECT * FROM split_final", "") + """,
counts AS (SELECT stance AS label, count(*) AS n FROM split_final GROUP BY stance),
dist AS (SELECT * FROM (VALUES ('support', 22.46e0, 0), ('deny', 14.13e0, 1), ('comment', 18.34e0, 2),
                               ('unrelated', 45.07e0, 3)) v(label, w, rk)),
avail AS (SELECT d.label, d.w, d.rk, coalesce(c.n, 0) AS n FROM dist d LEFT JOIN counts c ON c.label = d.label),
pairs2 AS (SELECT a.label AS a_label, a.rk AS a_rk, b.label AS b_label, b.n AS b_n,
                 b.w / a.w * a.n AS size FROM avail a, avail b),
ok AS (SELECT a_label, a_rk, bool_and(a_label = b_label OR size <= b_n) AS ok FROM pairs2 GROUP BY a_label, a_rk),
anchor AS (SELECT min(a_rk) AS rk FROM ok WHERE ok),
quota AS (SELECT b_label AS label,
                 CASE WHEN a_label = b_label THEN b_n + 1 ELSE CAST(floor(size) AS BIGINT) + 1 END AS quota
          FROM pairs2 WHERE a_rk = (SELECT rk FROM anchor)),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY stance ORDER BY idx) AS rn FROM split_final s)
SELECT r.idx, r.source, r.target, r.stance FROM ranked r JOIN quota q ON q.label = r.stance WHERE r.rn <= q.quota"""
    o["rescale_to_distribution"] = stance_pairs_sql().rstrip() + """,
data AS (SELECT doc_id, label AS stance FROM pairs),
counts AS (SELECT stance AS label, count(*) AS n FROM data GROUP BY stance),
dist AS (SELECT * FROM (VALUES ('support', 22.46e0, 0), ('deny', 14.13e0, 1), ('comment', 18.34e0, 2),
                               ('unrelated', 45.07e0, 3)) v(label, w, rk)),
avail AS (SELECT d.label, d.w, d.rk, coalesce(c.n, 0) AS n FROM dist d LEFT JOIN counts c ON c.label = d.label),
pairs2 AS (SELECT a.label AS a_label, a.rk AS a_rk, b.label AS b_label, b.n AS b_n,
                  b.w / a.w * a.n AS size FROM avail a, avail b),
ok AS (SELECT a_label, a_rk, bool_and(a_label = b_label OR size <= b_n) AS ok FROM pairs2 GROUP BY a_label, a_rk),
anchor AS (SELECT min(a_rk) AS rk FROM ok WHERE ok),
quota AS (SELECT b_label AS label,
                 CASE WHEN a_label = b_label THEN b_n + 1 ELSE CAST(floor(size) AS BIGINT) + 1 END AS quota
          FROM pairs2 WHERE a_rk = (SELECT rk FROM anchor)),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY stance ORDER BY doc_id) AS rn FROM data d)
SELECT r.doc_id, r.stance FROM ranked r JOIN quota q ON q.label = r.stance WHERE r.rn <= q.quota"""

    # value maps
    o["map_stance_rumour"] = with_(FX_THREADS) + f"SELECT thread, post, {case_map('label', RUMOUR)} AS label FROM fx_thread_labels WHERE {in_list('label', list(RUMOUR))}"
    o["map_stance_article"] = with_(FX_STANCE_ROWS) + f"SELECT doc_id, {case_map('stance', ARTICLE)} AS stance FROM fx_stance_rows WHERE {in_list('stance', list(ARTICLE))}"
    o["map_relation"] = with_(FX_STANCE_ROWS) + f"SELECT doc_id, {case_map('stance', RELATION)} AS stance FROM fx_stance_rows WHERE {in_list('stance', list(RELATION))}"
    o["map_paraphrase"] = with_(FX_PARAPHRASE) + f"SELECT doc_id, raw_label, {case_map('raw_label', PARAPHRASE)} AS label FROM fx_paraphrase"
    o["map_sentiment_binary"] = with_(FX_ANNOTATED) + "SELECT doc_id, sentiment, " + case_map("sentiment", {"negative": 0, "neutral": 1}) + " AS label FROM fx_annotated WHERE sentiment IS NOT NULL"
    o["flatten_newlines"] = with_(FX_STANCE_PAIRS) + "SELECT doc_id, replace(body, chr(10), ' ') AS source FROM fx_stance_pairs"
    o["simple_clean"] = with_(FX_ANNOTATED) + f"SELECT doc_id, {simple_clean('source')} AS source, {simple_clean('target')} AS target FROM fx_annotated"
    o["rstrip_label"] = with_(FX_PAIRS_BLANK) + f"SELECT idx, {py_rstrip('label')} AS label FROM fx_pairs_blank"
    o["softmax_rows"] = with_(FX_LOGITS, LOGIT_SOFTMAX) + "SELECT idx, " + ", ".join(
        f"round(ea[{i + 1}] / (ea[1] + ea[2] + ea[3]), 9) AS p{i}" for i in range(3)) + " FROM sm"
    o["home_url"] = f"SELECT page_id, {home_url('url')} AS home_url FROM pages"
    o["page_titles"] = with_(FX_PAGE_HEADLINES) + "SELECT url_id, full_url, headline, media, clean FROM fx_page_headlines"

    # filters
    o["drop_blank_pairs"] = with_(FX_PAIRS_BLANK) + f"SELECT idx, label FROM fx_pairs_blank WHERE {has_text('source')} AND {has_text('target')}"
    o["drop_unknown_labels"] = with_(FX_STANCE_ROWS) + f"SELECT doc_id, stance FROM fx_stance_rows WHERE {in_list('stance', list(ARTICLE))}"
    o["keep_clean_rows"] = with_(FX_ANNOTATED) + "SELECT doc_id FROM fx_annotated WHERE clean = 1"
    o["drop_report_rows"] = with_(FX_ANNOTATED) + "SELECT doc_id, stance FROM fx_annotated WHERE (stance IS NULL OR stance <> 'report') AND NOT (doc_id IS NULL AND source IS NULL AND target IS NULL AND sentiment IS NULL)"
    o["keep_comment_sentiment"] = with_(FX_ANNOTATED) + "SELECT doc_id, sentiment FROM fx_annotated WHERE clean = 1 AND stance = 'comment' AND sentiment IS NOT NULL AND sentiment <> ''"
    o["keep_nonempty_urls"] = with_(FX_MENTIONS) + "SELECT news_label, news_id, post_id, expanded_url AS url FROM fx_mentions WHERE length(expanded_url) > 0"
    o["batch_window"] = ARTICLE_ROWS.rstrip() + """,
pos AS (SELECT *, row_number() OVER (PARTITION BY news_label ORDER BY news_id, post_id) - 1 AS p FROM posts),
st AS (SELECT *, min(p) OVER (PARTITION BY news_label, news_id) AS start FROM pos)
SELECT news_label, news_id, post_id FROM st WHERE p > 3 AND start <= 40"""
    o["cap_list_per_event"] = EVENTS + "SELECT event_id, label, array_to_string(post_ids[1:5], ' ') AS post_ids FROM events_parsed"

    # joins
    o["join_stance_bodies"] = stance_pairs_sql() + "SELECT doc_id, raw_source AS source, target, label FROM joined"
    o["join_articles_posts"] = ARTICLE_ROWS.rstrip() + """,
t AS (SELECT news_id, 0 AS target_kind, title AS target FROM fx_articles
      UNION ALL SELECT news_id, 1 AS target_kind, description AS target FROM fx_articles)
SELECT p.news_id, p.post_id, t.target_kind, replace(p.post, chr(10), ' ') AS source, t.target, 'comment' AS label
FROM posts p JOIN t ON t.news_id = p.news_id WHERE length(t.target) > 0"""
    o["join_thread_pairs"] = THREAD_INPUTS + "SELECT * FROM j03"
    o["join_source_headlines"] = THREAD_INPUTS + "SELECT * FROM j04"
    o["propagate_headline_labels"] = THREAD_INPUTS.rstrip() + J05_SQL + "SELECT * FROM j05"
    o["unmatched_report"] = THREAD_INPUTS.rstrip() + """,
e AS (
  SELECT e.thread, e.parent, e.node, p.post IS NOT NULL AS pt, n.post IS NOT NULL AS nt, l.post IS NOT NULL AS lt
  FROM fx_thread_edges e LEFT JOIN posts p ON p.thread = e.thread AND p.post = e.parent
  LEFT JOIN posts n ON n.thread = e.thread AND n.post = e.node
  LEFT JOIN fx_thread_labels l ON l.thread = e.thread AND l.post = e.node)
SELECT thread, CAST(CASE WHEN NOT pt THEN parent ELSE node END AS VARCHAR) AS item,
       CASE WHEN NOT pt OR NOT nt THEN 'no_text' ELSE 'no_label' END AS reason
FROM e WHERE NOT pt OR NOT nt OR NOT lt
UNION ALL
SELECT s.thread, CAST(s.post AS VARCHAR), 'no_label' FROM posts s
WHERE s.is_source AND NOT EXISTS (SELECT 1 FROM fx_thread_labels l WHERE l.thread = s.thread AND l.post = s.post)
UNION ALL
SELECT m.thread, CAST(m.url_id AS VARCHAR), 'no_headline' FROM fx_thread_manifest m
WHERE m.url_id NOT IN (SELECT url_id FROM headline_table)"""
    o["zip_predictions_truth"] = PREDS + "SELECT idx, pred, truth FROM fx_preds"
    o["combine_stance_relation"] = PREDS + "SELECT idx, CASE WHEN relation = 'unrelated' THEN 'unrelated' ELSE pred END AS label FROM fx_preds"
    o["pipeline_stance_relation"] = PREDS + """SELECT idx, CASE WHEN relation = 'unrelated' THEN 'unrelated' ELSE pred END AS label, 0 AS corpus FROM fx_preds
UNION ALL SELECT idx, CASE WHEN relation = 'unrelated' THEN 'unrelated' ELSE truth END AS label, 1 AS corpus FROM fx_preds
UNION ALL SELECT idx, CASE WHEN idx % 3 = 0 THEN 'unrelated' ELSE pred END, 2 FROM fx_preds
UNION ALL SELECT idx, CASE WHEN idx % 3 = 0 THEN 'unrelated' ELSE truth END, 3 FROM fx_preds"""
    o["override_merge"] = with_(FX_THREADS, FX_THREAD_DEV_LABELS) + """SELECT coalesce(d.thread, t.thread) AS thread, coalesce(d.post, t.post) AS post,
  CASE WHEN d.post IS NOT NULL THEN d.label ELSE t.label END AS label
FROM fx_thread_labels t FULL OUTER JOIN fx_thread_dev_labels d ON d.thread = t.thread AND d.post = t.post"""
    summary = with_(FX_LOGITS, LOGIT_SOFTMAX) + """SELECT t.idx, t.source, t.target, t.stance,
  (['support', 'deny', 'comment'])[list_position(s.la, list_max(s.la))] AS fnc_predictions,
""" + ",\n".join(f"  round(s.ea[{i + 1}] / (s.ea[1] + s.ea[2] + s.ea[3]), 9) AS fnc_{c}" for i, c in enumerate(["support", "deny", "comment"])) + """,
  (['support', 'deny', 'comment'])[list_position(s.lb, list_max(s.lb))] AS re17_predictions,
""" + ",\n".join(f"  round(s.eb[{i + 1}] / (s.eb[1] + s.eb[2] + s.eb[3]), 9) AS re17_{c}" for i, c in enumerate(["support", "deny", "comment"])) + """
FROM fx_logit_test t JOIN sm s ON s.idx = t.idx"""
    o["experiment_summary"] = summary
    o["pipeline_summary"] = summary
    o["pair_semi_anti_split"] = PAIRS + """SELECT p.id1, p.id2, CASE WHEN d.id1 IS NOT NULL THEN 'dev' ELSE 'train' END AS split
FROM fx_pair_rows p LEFT JOIN (SELECT DISTINCT id1, id2 FROM fx_dev_ids) d ON d.id1 = p.id1 AND d.id2 = p.id2"""
    o["pipeline_sentence_pairs"] = PAIRS + """SELECT p.id1 || '-' || p.id2 AS pair_id, p.s1, p.s2, p.label,
  CASE WHEN d.id1 IS NOT NULL THEN 'dev' ELSE 'train' END AS split
FROM fx_pair_rows p LEFT JOIN (SELECT DISTINCT id1, id2 FROM fx_dev_ids) d ON d.id1 = p.id1 AND d.id2 = p.id2
UNION ALL SELECT id2 || '-' || id1, s2, s1, label, 'test' FROM fx_pair_rows"""

    # aggregates and metrics
    homes = with_(FX_MENTIONS, f"""homes AS (SELECT DISTINCT news_label, news_id, {home_url('expanded_url')} AS home
  FROM fx_mentions WHERE length(expanded_url) > 0)""")
    o["mentioned_urls_by_event"] = homes + """SELECT a.news_label, a.news_id, coalesce(h.urls, '') AS mentioned_urls
FROM (SELECT DISTINCT news_label, news_id FROM fx_mentions) a LEFT JOIN (
  SELECT news_label, news_id, array_to_string(list_sort(list(home)), ' ') AS urls FROM homes GROUP BY news_label, news_id) h
ON h.news_label = a.news_label AND h.news_id = a.news_id"""
    freq = homes.rstrip() + """,
freq AS (SELECT home AS mentioned_url, count(*) AS frequency,
                sum(CASE WHEN news_label = 'fake' THEN 1 ELSE 0 END) AS f,
                sum(CASE WHEN news_label = 'real' THEN 1 ELSE 0 END) AS r FROM homes GROUP BY home)
"""
    o["mentioned_url_frequency"] = freq + """SELECT mentioned_url, CAST(frequency AS BIGINT) AS frequency,
  CASE WHEN f > r THEN 'fake' WHEN f < r THEN 'real' ELSE 'tie' END AS label FROM freq"""
    o["source_url_frequency"] = with_(FX_ARTICLES) + f"SELECT {home_url('url')} AS source_url, CAST(count(*) AS BIGINT) AS frequency FROM fx_articles GROUP BY 1"
    o["order_by_frequency"] = with_(FX_ARTICLES) + f"""SELECT source_url, frequency,
  CAST(row_number() OVER (ORDER BY frequency DESC, source_url ASC) AS BIGINT) AS rank FROM (
  SELECT {home_url('url')} AS source_url, CAST(count(*) AS BIGINT) AS frequency FROM fx_articles GROUP BY 1)"""
    o["label_histogram"] = sp + "SELECT label, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY label"
    o["confusion_matrix"] = PREDS + "SELECT truth, pred, CAST(count(*) AS BIGINT) AS n FROM fx_preds GROUP BY truth, pred"
    cls = PREDS.rstrip() + ",\n" + PER_LABEL + "\n"
    o["class_metrics"] = cls + "SELECT label, round(prec, 9) AS precision, round(rec, 9) AS recall, round(f, 9) AS f1 FROM per_m"
    o["overall_metrics"] = cls + """SELECT round(acc, 9) AS accuracy, round(acc, 9) AS micro_precision, round(acc, 9) AS micro_recall,
  round(acc, 9) AS micro_f1, round(mp, 9) AS macro_precision, round(mr, 9) AS macro_recall, round(mf, 9) AS macro_f1 FROM overall"""
    report = cls + """SELECT 0 AS position, label, CAST(NULL AS DOUBLE) AS accuracy, round(prec, 9) AS precision, round(rec, 9) AS recall, round(f, 9) AS f1 FROM per_m
UNION ALL SELECT 1, 'macro', round(acc, 9), round(mp, 9), round(mr, 9), round(mf, 9) FROM overall
UNION ALL SELECT 2, 'micro', NULL, round(acc, 9), round(acc, 9), round(acc, 9) FROM overall"""
    o["metrics_report"] = report
    o["pipeline_evaluate"] = report
    o["label_union_set"] = PREDS + "SELECT pred AS label FROM fx_preds UNION SELECT truth FROM fx_preds"

    # indexing
    o["global_index"] = with_(FX_ANNOTATED) + "SELECT doc_id, CAST(row_number() OVER (ORDER BY batch, news_label, doc_id) - 1 AS BIGINT) AS idx FROM fx_annotated"
    o["kfold_contiguous"] = with_(FX_STANCE_PAIRS) + "SELECT doc_id, CAST(ntile(10) OVER (ORDER BY doc_id) AS BIGINT) AS fold FROM fx_stance_pairs"
    o["holdout_split"] = """SELECT idx, CASE WHEN p < ceil(0.05e0 * n) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id AS idx, row_number() OVER (ORDER BY md5('9-' || CAST(doc_id AS VARCHAR))) - 1 AS p, count(*) OVER () AS n FROM documents)"""
    o["drop_duplicate_pairs"] = with_(FX_ANNOTATED) + """SELECT CAST(row_number() OVER (ORDER BY batch, news_label, doc_id) AS BIGINT) AS idx, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY batch, news_label, doc_id) AS rk FROM fx_annotated) WHERE rk = 1"""
    o["keep_one_per_key"] = with_(FX_ANNOTATED) + "SELECT target, max(doc_id) AS doc_id FROM fx_annotated GROUP BY target"
    o["head_per_group"] = sp + "SELECT label, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM pairs) WHERE rn <= 5"
    o["seeded_shuffle"] = "SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('9-' || CAST(doc_id AS VARCHAR))) - 1 AS BIGINT) AS pos FROM documents"

    # sets
    o["union_datasets"] = (stance_pairs_sql() + "SELECT doc_id, label, 0 AS dataset FROM pairs\nUNION ALL\n"
                           + stance_pairs_sql(RELATION).replace("WITH ", "SELECT doc_id, label, 1 AS dataset FROM (WITH ", 1)
                           + "SELECT * FROM pairs)")
    o["union_batches"] = with_(FX_ANNOTATED) + """SELECT CASE WHEN news_label = 'fake' THEN 0 ELSE 1 END AS ordinal, doc_id, stance
FROM fx_annotated WHERE news_label IN ('fake', 'real')"""
    o["union_label_classes"] = with_(FX_MENTIONS) + "SELECT post_id, news_label FROM fx_mentions"

    # quality
    o["validate_pairs"] = with_(FX_STANCE_PAIRS) + f"""SELECT r.rule, CAST(r.violations AS BIGINT) AS violations FROM (
  SELECT unnest([
    {{'rule': 'source_present_string', 'violations': sum(CASE WHEN body IS NULL THEN 1 ELSE 0 END)}},
    {{'rule': 'target_present_string', 'violations': sum(CASE WHEN headline IS NULL THEN 1 ELSE 0 END)}},
    {{'rule': 'label_present_string', 'violations': sum(CASE WHEN NOT coalesce({in_list('raw_stance', list(ARTICLE))}, false) THEN 1 ELSE 0 END)}}
  ]) AS r FROM fx_stance_pairs)"""
    o["validate_label_domain"] = with_(FX_STANCE_ROWS) + f"""SELECT stance AS label, CAST(count(*) AS BIGINT) AS violations FROM fx_stance_rows
WHERE NOT coalesce({in_list('stance', STANCE_DOMAIN)}, false) GROUP BY stance"""
    o["assert_equal_sizes"] = PREDS + """SELECT coalesce(l.idx, r.idx) AS idx, l.idx IS NOT NULL AS in_left, r.idx IS NOT NULL AS in_right
FROM (SELECT idx FROM fx_preds WHERE idx % 7 <> 0) l FULL OUTER JOIN (SELECT idx FROM fx_preds WHERE idx % 11 <> 0) r ON l.idx = r.idx
WHERE l.idx IS NULL OR r.idx IS NULL"""

    # layouts
    o["sts_layout"] = sp + """SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS "index", 'none' AS genre, 'none' AS filename,
  'none' AS "year", 'none' AS old_index, 'none' AS source1, 'none' AS source2, source AS sentence1, target AS sentence2, label AS stance FROM pairs"""
    o["sst_layout"] = with_(FX_ANNOTATED) + "SELECT source AS sentence, " + case_map("sentiment", {"negative": 0, "neutral": 1}) + """ AS label
FROM fx_annotated WHERE clean = 1 AND stance = 'comment' AND sentiment IS NOT NULL AND sentiment <> ''"""
    o["pair_layout"] = PAIRS + "SELECT id1 || '-' || id2 AS pair_id, s1, s2, label FROM fx_pair_rows"
    o["event_layout"] = EVENTS + """SELECT CASE label WHEN 'label:1' THEN 'fake' ELSE 'real' END AS news_label, event_id AS id,
  'PLEASE_ENTER_URL' AS news_url, 'PLEASE_ENTER_TITLE' AS title, array_to_string(post_ids, chr(9)) AS tweet_ids
FROM events_parsed WHERE label IN ('label:0', 'label:1')"""
    o["write_events"] = o["event_layout"]
    o["pipeline_event_lines"] = o["event_layout"].replace("array_to_string(post_ids, chr(9))", "array_to_string(post_ids[1:50], chr(9))")

    # scans over derived text
    o["scan_label_maps"] = o["override_merge"].replace("coalesce(d.post, t.post) AS post", "CAST(coalesce(d.post, t.post) AS VARCHAR) AS post")
    o["scan_headlines"] = with_(FX_PAGE_HEADLINES) + """SELECT url_id, full_url, headline FROM (
  SELECT CAST(floor(url_id / 2) AS BIGINT) AS url_id, full_url, headline,
         row_number() OVER (PARTITION BY floor(url_id / 2) ORDER BY url_id DESC) AS rk
  FROM fx_page_headlines WHERE url_id % 9 <> 0) WHERE rk = 1"""
    o["scan_reply_edges"] = """SELECT conv_id AS thread, CAST(CAST(floor((turn - 1) / 2) AS BIGINT) AS VARCHAR) AS parent, CAST(turn AS VARCHAR) AS node
FROM conversations WHERE turn > 0"""
    o["scan_event_lines"] = EVENTS + "SELECT event_id, label, CAST(len(post_ids) AS BIGINT) AS n_ids, array_to_string(post_ids, ' ') AS post_ids FROM events_parsed"
    o["scan_sentence_pairs"] = PAIRS + "SELECT label, id1, id2, s1, s2 FROM fx_pair_rows"
    o["scan_logits"] = with_(FX_LOGITS) + """SELECT CAST(floor(idx / 100) AS BIGINT) AS block,
  CAST(row_number() OVER (PARTITION BY floor(idx / 100) ORDER BY idx) - 1 AS BIGINT) AS pos,
  round(la[1], 9) AS l0, round(la[2], 9) AS l1, round(la[3], 9) AS l2 FROM fx_logit_models"""

    # text
    o["explode_paragraphs"] = with_(FX_STANCE_PAIRS, "src AS (SELECT doc_id, body AS source, headline AS target FROM fx_stance_pairs)",
                                    paragraphs_sql("src")) + "SELECT doc_id, para, source, target FROM paragraphs"
    o["strip_urls"] = with_(FX_URL_TEXT) + f"SELECT page_id, regexp_replace(text, {q(URL_PATTERN)}, ', ', 'g') AS text FROM fx_url_text"
    punct_keep = "".join(ch for ch in ASCII_PUNCTUATION if ch not in "@#")
    words = f"regexp_split_to_array({py_strip(f'translate(text, {q(punct_keep)}, {q(' ' * len(punct_keep))})')}, {q(WS + '+')})"
    o["strip_tags"] = f"""SELECT doc_id, array_to_string(list_filter({words}, lambda w: w <> '' AND NOT starts_with(w, '@') AND NOT starts_with(w, '#')), ' ') AS text FROM documents"""
    o["strip_punctuation"] = f"SELECT doc_id, translate(text, {q(ASCII_PUNCTUATION)}, '') AS text FROM documents"
    from quarry.functions.text import NUMBER_PATTERN
    o["numeric_token_filter"] = f"""SELECT doc_id, CAST(count(*) AS BIGINT) AS kept FROM (
  SELECT doc_id, unnest(regexp_split_to_array({py_strip('text')}, {q(WS + '+')})) AS token FROM documents)
WHERE token <> '' AND NOT regexp_matches(token, {q(NUMBER_PATTERN)}) GROUP BY doc_id"""
    return o


def _file_and_pipeline_queries() -> dict[str, str]:
    from quarry.functions.text import PY_LINE_BREAK as LB
    o: dict[str, str] = {}
    o["common_vocabulary"] = r"""SELECT word, count, CAST(row_number() OVER (ORDER BY count DESC, word ASC) AS BIGINT) AS rank FROM (
  SELECT word, CAST(count(*) AS BIGINT) AS count FROM (
    SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents)
  GROUP BY word ORDER BY count DESC, word ASC LIMIT 20000)"""
    j02 = ARTICLE_ROWS.rstrip() + """,
t AS (SELECT news_id, 0 AS target_kind, title AS target FROM fx_articles
      UNION ALL SELECT news_id, 1 AS target_kind, description AS target FROM fx_articles),
j02 AS (
  SELECT p.news_label, p.news_id, p.post_id, t.target_kind, replace(p.post, chr(10), ' ') AS source, t.target, 'comment' AS label
  FROM posts p JOIN t ON t.news_id = p.news_id WHERE length(t.target) > 0)"""
    # C08 on whole texts: "b[i:i+k] occurs in a" is monotone in k, so each
    # start i of the target grows only while it still matches (work ~ |b| x LCS
    # length per pair); ties: the candidate occurring first in a
    o["longest_common_substring"] = j02 + """,
pairs AS (SELECT news_id, post_id, target_kind, source AS a, target AS b FROM j02),
ext AS (
  WITH RECURSIVE grow(news_id, post_id, target_kind, i, k) AS (
    SELECT news_id, post_id, target_kind, unnest(range(1, length(b) + 1)), 0 FROM pairs
    UNION ALL
    SELECT g.news_id, g.post_id, g.target_kind, g.i, g.k + 1
    FROM grow g JOIN pairs p
      ON p.news_id = g.news_id AND p.post_id = g.post_id AND p.target_kind = g.target_kind
    WHERE g.i + g.k <= length(p.b) AND contains(p.a, substring(p.b, g.i, g.k + 1)))
  SELECT news_id, post_id, target_kind, i, max(k) AS k FROM grow GROUP BY ALL),
longest AS (SELECT news_id, post_id, target_kind, max(k) AS len FROM ext GROUP BY ALL),
cands AS (
  SELECT e.news_id, e.post_id, e.target_kind, substring(p.b, e.i, e.k) AS sub,
         instr(p.a, substring(p.b, e.i, e.k)) AS pos
  FROM ext e JOIN longest l USING (news_id, post_id, target_kind)
  JOIN pairs p USING (news_id, post_id, target_kind) WHERE e.k = l.len AND l.len > 0),
best AS (SELECT news_id, post_id, target_kind, arg_min(sub, pos) AS lcs FROM cands GROUP BY ALL)
SELECT p.news_id, p.post_id, p.target_kind, coalesce(b.lcs, '') AS lcs
FROM pairs p LEFT JOIN best b USING (news_id, post_id, target_kind)"""
    o["pipeline_article_posts"] = j02 + """
SELECT news_label, CAST(row_number() OVER (PARTITION BY news_label ORDER BY news_id, post_id, target_kind) - 1 AS BIGINT) AS idx,
       source, target, label AS stance FROM j02"""
    # posts after the fourth of a side, of articles that start at its 41st post at the latest
    o["pipeline_article_posts_range"] = ARTICLE_ROWS.rstrip() + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY news_label ORDER BY news_id, post_id) - 1 AS nth FROM posts),
chosen AS (SELECT * FROM (SELECT *, min(nth) OVER (PARTITION BY news_label, news_id) AS begins FROM numbered) WHERE nth > 3 AND begins <= 40),
targets AS (SELECT news_id, 0 AS target_kind, title AS target FROM fx_articles
            UNION ALL SELECT news_id, 1 AS target_kind, description AS target FROM fx_articles)
SELECT news_label, CAST(row_number() OVER (PARTITION BY news_label ORDER BY c.news_id, post_id, target_kind) - 1 AS BIGINT) AS idx,
       replace(post, chr(10), ' ') AS source, target, 'comment' AS stance
FROM chosen c JOIN targets t ON t.news_id = c.news_id WHERE length(target) > 0"""
    o["scan_article_tree"] = with_(FX_ARTICLES) + """SELECT 'politifact' AS dataset, news_label, CAST(news_id AS VARCHAR) AS news_id, url, title, description FROM fx_articles"""
    o["pipeline_stance_files"] = pipeline_stance_sql()
    o["pipeline_url_analysis"] = with_(FX_MENTIONS, FX_ARTICLES) .rstrip() + f""",
sites AS (SELECT DISTINCT news_label, news_id, {home_url('expanded_url')} AS site FROM fx_mentions WHERE length(expanded_url) > 0),
lists AS (SELECT news_label, news_id, array_to_string(list_sort(list(site)), ' ') AS urls FROM sites GROUP BY news_label, news_id),
mentioned AS (SELECT site, count(*) AS n, count(*) FILTER (news_label = 'fake') AS fakes, count(*) FILTER (news_label = 'real') AS reals FROM sites GROUP BY site),
published AS (SELECT {home_url('url')} AS site, count(*) AS n FROM fx_articles GROUP BY 1)
SELECT 'mentions' AS output, CAST(a.news_id AS VARCHAR) AS news_id, coalesce(urls, '') AS urls, a.news_label AS label,
       CAST(NULL AS BIGINT) AS frequency, CAST(NULL AS BIGINT) AS rank
FROM (SELECT DISTINCT news_label, news_id FROM fx_mentions) a LEFT JOIN lists l ON l.news_label = a.news_label AND l.news_id = a.news_id
UNION ALL SELECT 'mentioned', NULL, site, CASE WHEN fakes > reals THEN 'fake' WHEN fakes < reals THEN 'real' ELSE 'tie' END, n,
       row_number() OVER (ORDER BY n DESC, site) FROM mentioned
UNION ALL SELECT 'sources', NULL, site, NULL, n, row_number() OVER (ORDER BY n DESC, site) FROM published"""
    for key, filt in (("pipeline_rumour_threads", "TRUE"), ("pipeline_rumour_forum", "h.headline <> 'Page not found'")):
        o[key] = thread_inputs(filt).rstrip() + J05_SQL.rstrip() + """,
allrows AS (
  SELECT thread, post AS node, 0 AS part, source, target, label AS stance FROM j04
  UNION ALL SELECT thread, node, 1, source, target, label FROM j03
  UNION ALL SELECT thread, node, 2, source, target, label FROM j05)
""" + cross_eval_sql("allrows", "thread, node, part, target")
    o["scan_delimited"] = "SELECT CAST(doc_id AS VARCHAR) AS body_id, coalesce(text, '') AS body FROM documents"
    o["write_delimited"] = pipeline_stance_sql().replace("SELECT * FROM split_final", """SELECT CAST(idx AS VARCHAR) AS idx, source, target, stance, split,
       coalesce(CAST(fold AS VARCHAR), '') AS fold FROM split_final""")
    o["write_lines"] = "SELECT url AS value FROM pages"
    o["scan_lines"] = (
        "SELECT unnest(string_split_regex(regexp_replace(text, chr(13) || '$', ''), "
        r"'\r\n|[\n\x0B\f\r\x1C-\x1E\x{85}\x{2028}\x{2029}]')) AS value FROM documents")
    o["scan_json_objects"] = with_(FX_ARTICLES) + "SELECT CAST(news_id AS VARCHAR) AS news_id, url, title, description FROM fx_articles"
    o["scan_thread_tree"] = with_(FX_THREADS) + "SELECT CAST(thread AS VARCHAR) AS thread, CAST(post AS VARCHAR) AS post, text, is_source FROM fx_thread_posts"
    o["scan_url_manifest"] = with_(FX_THREAD_MANIFEST) + "SELECT CAST(thread AS VARCHAR) AS thread, CAST(url_id AS VARCHAR) AS url_id, short_url, full_url FROM fx_thread_manifest"
    o["scan_stance_corpus"] = stance_pairs_sql() + "SELECT CAST(doc_id AS VARCHAR) AS body_id, raw_source AS source, target, label FROM joined"
    o["scan_annotation_batches"] = with_(FX_ANNOTATED) + "SELECT batch, news_label, doc_id, stance, sentiment, clean FROM fx_annotated"
    o["write_folds"] = pipeline_stance_sql().replace("SELECT * FROM split_final", """,
folds AS (SELECT unnest(range(1, 11)) AS f)
SELECT CAST(f.f AS BIGINT) AS fold, CASE WHEN s.fold = f.f THEN 'dev' ELSE 'train' END AS split, CAST(s.idx AS VARCHAR) AS idx, s.source, s.target, s.stance
FROM split_final s, folds f WHERE s.split = 'train'""")
    return o
