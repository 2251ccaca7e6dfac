"""The queries again as SQL text, written independently of the DataFrame code: flat rows, joins and windows."""

from __future__ import annotations

from workload import tables as W
from workload.queries import CHANNEL, FROM_DATE, PAGE_SIZE

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
KEPT = "가-힣a-zA-Z0-9À-ÖØ-öø-ÿ"
WORD = r"[\p{L}\p{N}]+"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{WS}]+', ''), '[{WS}]+$', '')"


def blanked(x: str) -> str:
    trimmed = strip(f"replace({x}, chr(13)||chr(10), '')")
    return f"regexp_replace({trimmed}, '[.!_+*&^%$#@`~:;,，]', ' ', 'g')"


def kept(x: str) -> str:
    letters = f"regexp_replace({blanked(x)}, '[^{KEPT}{WS}]', '', 'g')"
    return strip(f"replace(replace({letters}, chr(13), ''), chr(10), '')")


def untagged(x: str) -> str:
    return f"regexp_replace({x}, '/[A-Z]+[_]*[+]*', '', 'g')"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}')"


def padded(x: str) -> str:
    return f"(' ' || array_to_string({words(f'coalesce({x}, {chr(39)*2})')}, ' ') || ' ')"


def listed(pieces: str, idx: str) -> str:
    """Select-list pair that unnests `pieces` with its ordinal."""
    return f"unnest({pieces}) AS piece, unnest(range(len({pieces}))) AS {idx}"


# -- documents and control tables ------------------------------------------------------------------------

CRAWL = """crawl AS (
 SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d.doc_id % 365 AS INT)) AS doc_datetime,
  'writer' || (d.doc_id % 97) AS doc_writer, p.url AS doc_url, split_part(d.text, chr(10), 1) AS doc_title,
  d.text AS doc_content, CAST(d.doc_id % 97 AS VARCHAR) AS user_id, d.n_chars AS view_count,
  d.doc_id % 50 AS comment_count, d.doc_id % 7 AS like_count, CAST(0 AS BIGINT) AS dislike_count,
  d.doc_id % 3 AS share_count, CAST(NULL AS VARCHAR) AS locations, d.lang AS depth1_nm,
  CAST(CASE d.lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 WHEN 'es' THEN 4 END AS BIGINT) AS depth1_seq,
  d.source AS depth2_nm, CAST(regexp_extract(d.source, '[0-9]+') AS BIGINT) AS depth2_seq,
  CAST(NULL AS VARCHAR) AS depth3_nm, CAST(NULL AS BIGINT) AS depth3_seq, CAST(NULL AS VARCHAR) AS item_grp_nm,
  CAST(NULL AS BIGINT) AS item_grp_seq, CAST(NULL AS VARCHAR) AS item_nm, CAST(NULL AS BIGINT) AS item_seq
 FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id)"""

ORDER_QUEUE = """queue AS (
 SELECT o_orderkey AS seq, o_custkey AS user_seq, 'CCT00' || substr(o_orderpriority, 1, 1) AS type_cd,
  o_orderkey % 10 AS account_seq, o_orderdate AS reg_dt,
  CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 9) || ',' || (10 + o_orderkey % 4) END AS datasets,
  CASE o_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN 'all' WHEN 3 THEN '1^2,3;2^4' END AS channel,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate - INTERVAL 30 DAY END AS start_date, o_orderdate AS end_date,
  'N' AS compare_yn, CAST(NULL AS BIGINT) AS campaign_seq,
  CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'P' ELSE 'C' END AS status
 FROM orders)"""

RULE_TERMS = f"""rules AS ({W.RULES}), active AS (SELECT * FROM rules WHERE use_yn = 'Y'),
terms AS (
 SELECT rule_id, dataset_seq, kind, trim({padded('term')}) AS term FROM (
  SELECT rule_id, dataset_seq, 'need' AS kind, unnest(string_split(keyword || ',' || sub_keywords, ',')) AS term FROM active
  UNION ALL SELECT rule_id, dataset_seq, 'title', unnest(string_split(title_filter_keywords, ',')) FROM active
  UNION ALL SELECT rule_id, dataset_seq, 'content', unnest(string_split(content_filter_keywords, ',')) FROM active)),
urls AS (
 SELECT rule_id, lower(trim(url)) AS url
 FROM (SELECT rule_id, unnest(string_split(filter_urls, ',')) AS url FROM active) WHERE trim(url) <> ''),
texts AS (
 SELECT doc_id, doc_datetime, depth1_seq, depth2_seq, lower(coalesce(doc_url, '')) AS url,
  {padded('doc_title')} AS title, {padded('doc_content')} AS content FROM crawl),
need_counts AS (
 SELECT rule_id, count(DISTINCT term) AS n FROM terms WHERE kind = 'need' AND term <> '' GROUP BY rule_id),
needed AS (
 SELECT x.doc_id, x.url, x.title, x.content, t.rule_id, t.dataset_seq
 FROM texts x JOIN terms t ON t.kind = 'need' AND t.term <> ''
  AND (contains(x.title, ' ' || t.term || ' ') OR contains(x.content, ' ' || t.term || ' '))
 JOIN need_counts c ON c.rule_id = t.rule_id
 GROUP BY x.doc_id, x.url, x.title, x.content, t.rule_id, t.dataset_seq, c.n HAVING count(DISTINCT t.term) = c.n),
decided AS (
 SELECT n.doc_id, n.rule_id, n.dataset_seq,
  EXISTS (SELECT 1 FROM terms t WHERE t.rule_id = n.rule_id AND t.kind = 'title' AND t.term <> ''
   AND contains(n.title, ' ' || t.term || ' ')) AS title_excluded,
  EXISTS (SELECT 1 FROM terms t WHERE t.rule_id = n.rule_id AND t.kind = 'content' AND t.term <> ''
   AND contains(n.content, ' ' || t.term || ' ')) AS content_excluded,
  EXISTS (SELECT 1 FROM urls u WHERE u.rule_id = n.rule_id AND contains(n.url, u.url)) AS url_excluded
 FROM needed n),
matches AS (
 SELECT DISTINCT dataset_seq, doc_id FROM decided
 WHERE NOT title_excluded AND NOT content_excluded AND NOT url_excluded)"""

PENDING = f"""queue AS ({W.QUEUE}), users AS ({W.USERS}),
pending AS (SELECT q.* FROM queue q JOIN users u ON q.user_seq = u.seq WHERE q.status = 'I' AND u.use_yn = 'Y'),
asked AS (
 SELECT p.*, CAST(dataset AS BIGINT) AS dataset_seq
 FROM (SELECT *, unnest(CASE WHEN coalesce(datasets, '') = '' THEN [NULL] ELSE string_split(datasets, ',') END) AS dataset
       FROM pending) p)"""

MATCHED = f"""WITH {CRAWL}, {RULE_TERMS}, {PENDING},
channels AS (
 SELECT seq, split_part(entry, '^', 1) AS d1, unnest(string_split(split_part(entry, '^', 2), ',')) AS d2
 FROM (SELECT seq, unnest(string_split(channel, ';')) AS entry FROM pending WHERE coalesce(channel, 'all') NOT IN ('', 'all'))),
found AS (
 SELECT CAST(a.seq AS BIGINT) AS seq, a.dataset_seq, x.*
 FROM asked a JOIN crawl x
  ON x.doc_datetime BETWEEN coalesce(a.start_date, TIMESTAMP '1900-01-01 00:00:00') AND coalesce(a.end_date, TIMESTAMP '2100-12-31 23:59:59')
 WHERE (coalesce(a.channel, 'all') IN ('', 'all') OR EXISTS (
   SELECT 1 FROM channels c WHERE c.seq = a.seq AND CAST(c.d1 AS BIGINT) = x.depth1_seq AND CAST(c.d2 AS BIGINT) = x.depth2_seq))
  AND (a.dataset_seq IS NULL OR EXISTS (SELECT 1 FROM matches m WHERE m.dataset_seq = a.dataset_seq AND m.doc_id = x.doc_id)))
"""

# -- sentences, tags, clauses ----------------------------------------------------------------------------

DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS content FROM documents)"


def sentence_cte(source: str, keys: str, text: str, split: str) -> str:
    return f"""pieces AS (SELECT {keys}, {split.format(text)} AS list FROM {source}),
sents AS (
 SELECT {keys}, sentence_idx, {strip('piece')} AS sentence
 FROM (SELECT {keys}, {listed('list', 'sentence_idx')} FROM pieces) WHERE regexp_matches(piece, '[^{WS}]'))"""


BY_DOT = "string_split({}, '.')"
BY_MARKS = r"string_split_regex({}, '[.\-_~^?!]+')"
SURVEY = """survey AS (
 SELECT CAST(conv_id AS VARCHAR) AS case_id, CAST(turn AS VARCHAR) AS response_id, role AS answer_id, 'l1' AS language_id,
  text AS comment FROM conversations)"""


def tag_cte(source: str, keys: str, text: str, carried: str) -> str:
    """Tag `text` of `source`; `keys` identify a row and `carried` lists all columns to keep."""
    on = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM g.{k.strip()}" for k in keys.split(","))
    return f"""lexicon AS ({W.LEXICON}),
listed_words AS (
 SELECT {keys}, list_filter(string_split_regex(lower({kept(text)}), '[{WS}]+'), lambda w: w <> '') AS list FROM {source}),
flat_words AS (SELECT {keys}, {listed('list', 'word_idx')} FROM listed_words),
glued AS (
 SELECT {keys}, string_agg(coalesce(l.piece, w.piece || '/NNG'), ' ' ORDER BY word_idx) AS kma
 FROM flat_words w LEFT JOIN lexicon l ON l.word = w.piece GROUP BY {keys}),
tagged AS (
 SELECT {carried}, coalesce(g.kma, '') AS sentence_kma FROM {source} s LEFT JOIN glued g ON {on})"""


def clause_cte(keys: str, carried: str) -> str:
    """Clauses with part count, verb and subjects. All ordinals start at 0."""
    return rf"""clause_pieces AS (
 SELECT {carried}, sentence, len(string_split(sentence_kma, '/EM ')) AS n,
  unnest(string_split(sentence_kma, '/EM ')) AS clause_kma, unnest(range(len(string_split(sentence_kma, '/EM ')))) AS clause_idx
 FROM tagged),
clauses AS (
 SELECT * FROM (
  SELECT *, CASE WHEN n = 1 THEN {blanked('sentence')} ELSE {strip(untagged('clause_kma'))} END AS clause FROM clause_pieces)
 WHERE clause <> ''),
parsed AS (SELECT *, string_split_regex(clause_kma, '[은는이가도]/J_') AS parts FROM clauses),
clause_words AS (
 SELECT {keys}, clause_idx, word_idx, piece AS word,
  contains(piece, '/VA') OR contains(piece, '/VV') OR contains(piece, '/XSD') OR contains(piece, '/EM') AS is_verb
 FROM (SELECT {keys}, clause_idx, {listed("string_split(clause_kma, ' ')", 'word_idx')} FROM parsed WHERE len(parts) = 1)),
glued_verbs AS (
 SELECT {keys}, clause_idx, string_agg(' ' || {untagged(strip('word'))}, '' ORDER BY word_idx) AS verb
 FROM clause_words WHERE is_verb GROUP BY ALL),
verbed AS (
 SELECT p.*, len(p.parts) AS n_parts,
  CASE WHEN len(p.parts) = 1 THEN coalesce(g.verb, '') ELSE {untagged(strip('p.parts[2]'))} END AS verb
 FROM parsed p LEFT JOIN glued_verbs g USING ({keys}, clause_idx)),
subjects AS (
 SELECT {keys}, clause_idx, row_number() OVER (PARTITION BY {keys}, clause_idx ORDER BY word_idx) - 1 AS attr_idx,
  {untagged(strip('word'))} AS subject FROM clause_words WHERE NOT is_verb
 UNION ALL
 SELECT {keys}, clause_idx, attr_idx, {strip(untagged('piece'))} AS subject
 FROM (SELECT {keys}, clause_idx, {listed("string_split_regex(parts[len(parts) - 1], '[와과및]+/[(J_|MA)]+')", 'attr_idx')}
       FROM parsed WHERE len(parts) > 1))"""


def match_cte(name: str, source: str, text: str, dictionary: str) -> str:
    """`name`(text, value): best entry by shared tokens. `dictionary` gives key, value, words."""
    return f"""{name}_postings AS (
 SELECT DISTINCT key, value, unnest({words('words')}) AS token FROM ({dictionary})),
{name} AS (
 SELECT text, value FROM (
  SELECT text, value, row_number() OVER (PARTITION BY text ORDER BY count(*) DESC, key, value) AS rank
  FROM (SELECT DISTINCT text, unnest({words('text')}) AS token FROM (SELECT DISTINCT {text} AS text FROM {source})) t
  JOIN {name}_postings USING (token) GROUP BY text, key, value) WHERE rank = 1)"""


EMOTIONS = f"SELECT verb AS key, emotion AS value, verb AS words FROM ({W.VERB_DICT})"
CATEGORIES = (
    "SELECT category_eng AS key, subtopic_code AS value, category_eng || ' ' || category_kor || ' ' || synonym AS words "
    f"FROM ({W.CATEGORY})"
)
CATEGORY_TERMS = f"""category_terms AS (
 SELECT term, arg_min(code, [eng, code]) AS code FROM (
  SELECT unnest([category_eng, category_kor, synonym]) AS term, category_eng AS eng, subtopic_code AS code FROM ({W.CATEGORY}))
 WHERE term <> '' GROUP BY term)"""

DOC_KEYS = "doc_id, sentence_idx"
DOC_CHAIN = ", ".join(
    [DOCS, sentence_cte("docs", "doc_id", "content", BY_DOT), tag_cte("sents", DOC_KEYS, "sentence", "s.doc_id, s.sentence_idx, s.sentence")]
)
DOC_CLAUSES = f"{DOC_CHAIN}, {clause_cte(DOC_KEYS, DOC_KEYS)}"

SURVEY_ID = "case_id, response_id, answer_id, language_id"
SURVEY_KEYS = f"{SURVEY_ID}, sentence_idx"
SURVEY_CARRIED = ", ".join(f"s.{k.strip()}" for k in f"{SURVEY_KEYS}, sentence, content".split(","))
SURVEY_CHAIN = ", ".join(
    [
        SURVEY, "survey_docs AS (SELECT *, comment AS content FROM survey)",
        sentence_cte("survey_docs", f"{SURVEY_ID}, content", "comment", BY_MARKS),
        tag_cte("sents", SURVEY_KEYS, "sentence", SURVEY_CARRIED),
        clause_cte(SURVEY_KEYS, f"{SURVEY_KEYS}, content"),
    ]
)


def attribute_select(keys: str, columns: str) -> str:
    """All attribute rows, with sentiment and category."""
    return f"""{match_cte('emotion', 'verbed', 'verb', EMOTIONS)}, {CATEGORY_TERMS},
{match_cte('category', 'subjects', 'subject', CATEGORIES)},
attributes AS (
 SELECT {columns}, s.attr_idx, s.subject, CASE WHEN s.attr_idx IS NOT NULL THEN v.verb END AS verb,
  CASE WHEN s.attr_idx IS NOT NULL THEN coalesce(e.value, '') END AS sentiment,
  CASE WHEN s.attr_idx IS NOT NULL THEN coalesce(CASE WHEN v.n_parts = 1 THEN t.code ELSE c.value END, '') END AS category
 FROM verbed v JOIN subjects s USING ({keys}, clause_idx)
 LEFT JOIN emotion e ON e.text = v.verb LEFT JOIN category_terms t ON t.term = s.subject
 LEFT JOIN category c ON c.text = s.subject)"""


def label_select(keys: str) -> str:
    return f"""{match_cte('emotion', 'verbed', 'verb', EMOTIONS)},
labels_of AS (
 SELECT {keys}, clause_idx, CASE max(CASE trim(coalesce(e.value, '')) WHEN '부정' THEN 2 WHEN '긍정' THEN 1 ELSE 0 END)
   WHEN 2 THEN '부정' WHEN 1 THEN '긍정' ELSE '중립' END AS label
 FROM verbed JOIN subjects USING ({keys}, clause_idx) LEFT JOIN emotion e ON e.text = verb GROUP BY ALL),
labelled AS (
 SELECT v.*, coalesce(l.label, '중립') AS clause_sentiment FROM verbed v LEFT JOIN labels_of l USING ({keys}, clause_idx))"""


TOPIC = "CASE WHEN NOT contains(w, '/NNG') AND contains(w, '/XSV') THEN " + untagged("split_part(w, '/XSV', 1)") + " || '다'"
for _tag in ("NNG", "NNP", "SL", "NFU", "NFG", "FL", "VV", "VA"):
    _join = "array_to_string(list_transform(list_filter(string_split(w, '+'), lambda m: contains(m, '/%s')), lambda m: %s), '')" % (
        _tag, untagged("m"),
    )
    TOPIC += f" WHEN contains(w, '/{_tag}') THEN {_join}" + (" || '다'" if _tag in ("VV", "VA") else "")
TOPIC += " END"
TOPICS = f"list_filter(list_transform(string_split({{}}, ' '), lambda w: {TOPIC}), lambda t: t IS NOT NULL)"

STOP_IN_LEXICON = "('JX','JKS','JC','VV','VA','EC')"

# -- payload texts ---------------------------------------------------------------------------------------

PAYLOAD_CHAIN = ", ".join(
    [
        "raw AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents)",
        tag_cte("raw", "doc_id", "text", "s.doc_id, s.text, s.lang, s.source"),
        f"""checked AS (
 SELECT doc_id, {strip("replace(replace(text, chr(13), ''), chr(10), '')")} AS content, sentence_kma AS kma,
  CASE WHEN lang = 'es' THEN 'undecodable' WHEN lang = 'de' OR (lang = 'fr' AND source LIKE '%0') THEN 'no_result' ELSE 'ok' END AS quality
 FROM tagged)""",
    ]
)

CAUSE_CHAIN = f"""{DOCS},
raw_flat AS (SELECT doc_id, content, {listed("string_split(content, '.')", 'i')} FROM docs),
results AS (
 SELECT doc_id, content, {strip('piece')} AS sentence, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS result_idx
 FROM raw_flat WHERE len({words('piece')}) > 0),
causes AS (
 SELECT doc_id, content, sentence, result_idx, var_idx, CAST(ceil((80 * result_idx - result_idx % 2) / 2) AS BIGINT) AS start,
  CASE var_idx WHEN 0 THEN {words('sentence')}[1] ELSE {words('sentence')}[-1] END AS value
 FROM results CROSS JOIN (VALUES (0), (1)) v(var_idx)),
spans AS (
 SELECT *, row_number() OVER w - 1 AS cause_idx, coalesce(lead(start) OVER w, length(sentence)) - start AS span
 FROM causes WINDOW w AS (PARTITION BY doc_id ORDER BY start, result_idx, var_idx))"""

ORACLE: dict[str, str] = {}

ORACLE["channel_filter"] = f"""WITH {CRAWL},
pairs AS (
 SELECT split_part(entry, '^', 1) AS d1, unnest(string_split(split_part(entry, '^', 2), ',')) AS d2
 FROM (SELECT unnest(string_split('{CHANNEL}', ';')) AS entry))
SELECT doc_id, depth1_seq, depth2_seq FROM crawl
WHERE EXISTS (SELECT 1 FROM pairs WHERE CAST(d1 AS BIGINT) = depth1_seq AND CAST(d2 AS BIGINT) = depth2_seq)"""

ORACLE["date_range_filter"] = f"""WITH {CRAWL}
SELECT doc_id, strftime(doc_datetime, '%Y-%m-%d %H:%M:%S') AS doc_datetime FROM crawl
WHERE doc_datetime BETWEEN TIMESTAMP '{FROM_DATE}' AND TIMESTAMP '2100-12-31 23:59:59'"""

ORACLE["dataset_match"] = f"WITH {CRAWL}, {RULE_TERMS} SELECT CAST(dataset_seq AS BIGINT) AS dataset_seq, doc_id FROM matches"
ORACLE["dataset_exclusion"] = f"""WITH {CRAWL}, {RULE_TERMS}
SELECT doc_id, CAST(rule_id AS BIGINT) AS rule_id, CAST(title_excluded AS BIGINT) AS title_excluded,
 CAST(content_excluded AS BIGINT) AS content_excluded FROM decided"""
ORACLE["url_exclusion"] = f"""WITH {CRAWL}, {RULE_TERMS}
SELECT doc_id, CAST(rule_id AS BIGINT) AS rule_id, CAST(url_excluded AS BIGINT) AS url_excluded FROM decided"""

ORACLE["filter_documents"] = f"""{MATCHED}
SELECT seq, dataset_seq, doc_id, strftime(doc_datetime, '%Y-%m-%d %H:%M:%S') AS doc_datetime, doc_title, depth1_seq, depth2_seq
FROM found"""

ORACLE["filter_documents_stored"] = ORACLE["filter_documents"]

ORACLE["export_pages"] = f"""{MATCHED}
SELECT * EXCLUDE (p) REPLACE (strftime(doc_datetime, '%Y-%m-%d %H:%M:%S') AS doc_datetime), p // {PAGE_SIZE} AS page, p % {PAGE_SIZE} AS row_no
FROM (SELECT *, row_number() OVER (PARTITION BY seq, dataset_seq ORDER BY doc_datetime, doc_id) - 1 AS p FROM found)"""

ORACLE["export_manifest"] = f"""{MATCHED}, codes AS ({W.CODES}),
names AS (SELECT type_cd, min(name) AS type_name FROM codes GROUP BY type_cd),
totals AS (SELECT seq, dataset_seq, count(*) AS total FROM found GROUP BY seq, dataset_seq),
named AS (
 SELECT CAST(a.seq AS BIGINT) AS seq, a.dataset_seq, strftime(a.reg_dt, '%Y%m%d') || '/' || a.seq AS directory,
  concat_ws('_', CAST(a.seq AS VARCHAR), n.type_name,
   CASE WHEN coalesce(a.channel, 'all') IN ('', 'all') THEN '전채널' ELSE '채널일부' END,
   strftime(a.start_date, '%Y%m%d'), strftime(a.end_date, '%Y%m%d'), CAST(a.dataset_seq AS VARCHAR)) AS file_name,
  coalesce(t.total, 0) AS total
 FROM asked a LEFT JOIN names n USING (type_cd)
 LEFT JOIN totals t ON t.seq = a.seq AND t.dataset_seq IS NOT DISTINCT FROM a.dataset_seq)
SELECT seq, dataset_seq, directory, file_name || CASE WHEN page > 0 THEN '(' || page || ')' ELSE '' END AS file_name, total, page,
 least({PAGE_SIZE}, total - page * {PAGE_SIZE}) AS n_rows
FROM (SELECT *, unnest(range((total + {PAGE_SIZE} - 1) // {PAGE_SIZE})) AS page FROM named)
UNION ALL SELECT seq, dataset_seq, directory, NULL, total, NULL, 0 FROM named WHERE total = 0"""

ORACLE["exported_files"] = f"""WITH paged AS ({ORACLE["export_pages"]}), listed AS ({ORACLE["export_manifest"]})
SELECT seq, file_name, doc_id, nullif(doc_title, '') AS doc_title, view_count
FROM paged JOIN listed USING (seq, page) WHERE paged.dataset_seq IS NOT DISTINCT FROM listed.dataset_seq"""

ORACLE["pending_requests"] = f"""WITH {ORDER_QUEUE}
SELECT seq, user_seq, type_cd, account_seq, strftime(reg_dt, '%Y%m%d') AS reg_dt, datasets, channel,
 strftime(start_date, '%Y-%m-%d %H:%M:%S') AS start_date, strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date, compare_yn, campaign_seq
FROM queue JOIN customer ON c_custkey = user_seq WHERE status = 'I' AND c_mktsegment <> 'MACHINERY'"""

ORACLE["request_type_names"] = f"""WITH {ORDER_QUEUE}, codes AS ({W.CODES})
SELECT seq, type_cd, (SELECT min(name) FROM codes c WHERE c.type_cd = q.type_cd) AS type_name FROM queue q"""

ORACLE["request_datasets"] = f"""WITH {ORDER_QUEUE}, rules AS ({W.RULES}),
asked AS (
 SELECT seq, CAST(dataset AS BIGINT) AS dataset_seq FROM (
  SELECT seq, unnest(CASE WHEN datasets IS NULL THEN [NULL] ELSE string_split(datasets, ',') END) AS dataset FROM queue))
SELECT seq, a.dataset_seq, CAST(rule_id AS BIGINT) AS rule_id
FROM asked a LEFT JOIN rules r ON r.dataset_seq = a.dataset_seq AND r.use_yn = 'Y'"""

ORACLE["request_status"] = """WITH log AS (
 SELECT user_id AS seq, event_id, CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type IN ('click', 'view') THEN 'P' ELSE 'C' END AS status
 FROM events)
SELECT seq, status FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY event_id DESC) AS rank FROM log) WHERE rank = 1"""

ORACLE["sentences"] = f"WITH {DOCS}, {sentence_cte('docs', 'doc_id', 'content', BY_DOT)} SELECT doc_id, sentence_idx, sentence FROM sents"
ORACLE["sentences_multi"] = f"""WITH {SURVEY}, {sentence_cte('survey', SURVEY_ID, 'comment', BY_MARKS)}
SELECT {SURVEY_KEYS}, sentence FROM sents"""
ORACLE["clean_text"] = f"WITH {DOCS} SELECT doc_id, {blanked('content')} AS blanked, {kept('content')} AS kept FROM docs"
ORACLE["tag_tokens"] = f"WITH {DOC_CHAIN} SELECT doc_id, sentence_idx, sentence_kma FROM tagged"
ORACLE["strip_tags"] = f"WITH {DOC_CHAIN} SELECT doc_id, sentence_idx, {untagged('sentence_kma')} AS plain FROM tagged"
ORACLE["clauses"] = f"WITH {DOC_CLAUSES} SELECT doc_id, sentence_idx, clause_idx, clause_kma, clause FROM clauses"
ORACLE["conjunct_subjects"] = f"""WITH {DOC_CLAUSES}
SELECT doc_id, sentence_idx, clause_idx, attr_idx, subject FROM subjects JOIN verbed USING (doc_id, sentence_idx, clause_idx) WHERE n_parts > 1"""
ORACLE["topic_words"] = f"""WITH {DOC_CHAIN}
SELECT doc_id, sentence_idx, array_to_string({TOPICS.format('sentence_kma')}, ' ') AS topics FROM tagged"""

ORACLE["content_words"] = f"""WITH {DOC_CHAIN},
typed AS (
 SELECT doc_id, sentence_idx, word_idx, coalesce(l.token_type, 'NNG') AS type, w.piece AS word
 FROM flat_words w LEFT JOIN lexicon l ON l.word = w.piece),
content AS (
 SELECT doc_id, sentence_idx, count(*) AS n, string_agg(CASE WHEN type = 'XR' THEN word || '/XR' ELSE word END, '' ORDER BY word_idx) AS glued
 FROM typed WHERE type NOT IN {STOP_IN_LEXICON} GROUP BY doc_id, sentence_idx)
SELECT doc_id, sentence_idx, coalesce(n, 0) AS n_content, coalesce(glued, '') AS content_word
FROM sents LEFT JOIN content USING (doc_id, sentence_idx)"""

LEAD_LETTERS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
VOWEL_LETTERS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
TAIL_LETTERS = "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
ORACLE["normalize_hangul"] = f"""WITH {DOCS},
mixed AS (SELECT doc_id, translate(lower(content), 'aeiountrsdl', '가베히오ㅜㄴ하ㄹㅅㄷㅏ') AS t FROM docs),
chars AS (SELECT doc_id, unnest(string_split(t, '')) AS c, unnest(range(length(t))) AS i FROM mixed),
letters AS (
 SELECT doc_id, i, 0 AS k, CASE WHEN c BETWEEN '가' AND '힣' THEN substr('{LEAD_LETTERS}', (unicode(c) - 44032) // 588 + 1, 1) ELSE c END AS x FROM chars
 UNION ALL SELECT doc_id, i, 1, substr('{VOWEL_LETTERS}', ((unicode(c) - 44032) % 588) // 28 + 1, 1) FROM chars WHERE c BETWEEN '가' AND '힣'
 UNION ALL SELECT doc_id, i, 2, substr('{TAIL_LETTERS}', (unicode(c) - 44032) % 28, 1) FROM chars
  WHERE c BETWEEN '가' AND '힣' AND (unicode(c) - 44032) % 28 > 0),
near AS (
 SELECT doc_id, i, k, x, lead(x, 1, '') OVER w AS x1, lead(x, 2, '') OVER w AS x2, lead(x, 3, '') OVER w AS x3, lag(x, 1, '') OVER w AS p1, lag(x, 2, '') OVER w AS p2
 FROM letters WINDOW w AS (PARTITION BY doc_id ORDER BY i, k)),
flags AS (
 SELECT *, instr('{LEAD_LETTERS}', x) AS l0, instr('{VOWEL_LETTERS}', x) AS v0,
  CASE WHEN x1 = '' THEN 0 ELSE instr('{LEAD_LETTERS}', x1) END AS l1, CASE WHEN x1 = '' THEN 0 ELSE instr('{VOWEL_LETTERS}', x1) END AS v1,
  CASE WHEN x2 = '' THEN 0 ELSE instr('{TAIL_LETTERS}', x2) END AS t2, CASE WHEN x2 = '' THEN 0 ELSE instr('{LEAD_LETTERS}', x2) END AS l2,
  CASE WHEN x3 = '' THEN 0 ELSE instr('{VOWEL_LETTERS}', x3) END AS v3,
  CASE WHEN p1 = '' THEN 0 ELSE instr('{LEAD_LETTERS}', p1) END AS pl1, CASE WHEN p1 = '' THEN 0 ELSE instr('{VOWEL_LETTERS}', p1) END AS pv1,
  CASE WHEN p2 = '' THEN 0 ELSE instr('{LEAD_LETTERS}', p2) END AS pl2, instr('{TAIL_LETTERS}', x) AS t0 FROM near),
units AS (
 SELECT doc_id, i, k, CASE
   WHEN l0 > 0 AND v1 > 0 THEN chr(CAST(44032 + (l0 - 1) * 588 + (v1 - 1) * 28 + CASE WHEN t2 > 0 AND NOT (l2 > 0 AND v3 > 0) THEN t2 ELSE 0 END AS INT))
   WHEN v0 > 0 AND pl1 > 0 THEN ''
   WHEN t0 > 0 AND pv1 > 0 AND pl2 > 0 AND NOT (l0 > 0 AND v1 > 0) THEN ''
   ELSE x END AS u FROM flags)
SELECT doc_id, string_agg(u, '' ORDER BY i, k) AS content FROM units GROUP BY doc_id"""

HL, NW = "가-힣ㄱ-ㅎa-zA-ZÀ-ÖØ-öø-ÿ", "가-힣ㄱ-ㅎㅏ-ㅣa-zA-Z0-9À-ÖØ-öø-ÿ"
ORACLE["close_words"] = rf"""WITH {DOCS},
rest AS (
 SELECT doc_id, array_to_string(string_split_regex(regexp_replace(content, ' (the|th|de|der|la)', ' <em>\1</em>', 'g'),
  '<em>[{HL}{WS}]*</em>[{HL}]*'), ' ') AS t FROM docs),
found AS (SELECT doc_id, list_filter(string_split_regex(t, '[^{NW}]'), lambda w: w <> '') AS list FROM rest)
SELECT doc_id, len(list) AS n_words, array_to_string(list, ' ') AS words FROM found"""

ORACLE["related_words"] = rf"""WITH {DOCS}, lexicon AS ({W.LEXICON}),
asked AS (
 SELECT doc_id, list_filter([w[2], w[3]], lambda x: x IS NOT NULL) AS phrase, concat_ws(' ', w[2], w[3]) AS term, content FROM (SELECT doc_id, {words('content')} AS w, content FROM docs)),
fields AS (
 SELECT doc_id, phrase, 0 AS field, split_part(content, chr(10), 1) AS t FROM asked
 UNION ALL SELECT doc_id, phrase, 1, content FROM asked),
frags AS (SELECT doc_id, phrase, field, {listed("regexp_extract_all(t, '(?s).{1,30}[" + chr(92) + "p{L}" + chr(92) + "p{N}]*')", 'frag')} FROM fields),
toks AS (
 SELECT doc_id, phrase, field, frag, unnest({words('piece')}) AS word, unnest(range(len({words('piece')}))) AS j FROM frags),
placed AS (
 SELECT *, row_number() OVER w AS i, lead(word) OVER w AS following, lag(word) OVER w AS previous
 FROM toks WINDOW w AS (PARTITION BY doc_id, field ORDER BY frag, j)),
marked AS (
 SELECT *, (word = phrase[1] AND (len(phrase) = 1 OR coalesce(following = phrase[2], false)))
  OR coalesce(previous = phrase[1] AND word = phrase[2], false) AS hit FROM placed),
shown AS (
 SELECT doc_id, field, frag FROM (
  SELECT doc_id, field, frag, row_number() OVER (PARTITION BY doc_id, field ORDER BY frag) AS rank
  FROM (SELECT DISTINCT doc_id, field, frag FROM marked WHERE hit)) WHERE rank <= 5),
close AS (
 SELECT m.doc_id, m.field, m.i, m.word FROM marked m JOIN shown USING (doc_id, field, frag) LEFT JOIN lexicon l ON l.word = m.word
 WHERE NOT coalesce(m.hit, false) AND coalesce(l.token_type, 'NNG') NOT IN {STOP_IN_LEXICON} AND length(m.word) > 1),
firsts AS (SELECT doc_id, word, min([field, i]) AS first_at FROM close GROUP BY doc_id, word)
SELECT doc_id, a.term, row_number() OVER (PARTITION BY doc_id ORDER BY first_at) - 1 AS word_order, word FROM firsts JOIN asked a USING (doc_id)"""

ORACLE["emotion_exact"] = f"""WITH {DOC_CLAUSES}, verb_dict AS ({W.VERB_DICT})
SELECT doc_id, sentence_idx, clause_idx, {strip('v.verb')} AS verb, coalesce(d.emotion, '') AS emotion
FROM verbed v LEFT JOIN verb_dict d ON d.verb = {strip('v.verb')}"""
ORACLE["emotion_match"] = f"""WITH {DOC_CLAUSES}, {match_cte('emotion', 'verbed', 'verb', EMOTIONS)}
SELECT doc_id, sentence_idx, clause_idx, verb, coalesce(value, '') AS emotion FROM verbed LEFT JOIN emotion ON text = verb"""
ORACLE["category_exact"] = f"""WITH {DOC_CLAUSES}, {CATEGORY_TERMS}
SELECT doc_id, sentence_idx, clause_idx, attr_idx, subject, coalesce(code, '') AS category
FROM subjects LEFT JOIN category_terms ON term = subject"""
ORACLE["category_match"] = f"""WITH {DOC_CLAUSES}, {match_cte('category', 'subjects', 'subject', CATEGORIES)}
SELECT doc_id, sentence_idx, clause_idx, attr_idx, subject, coalesce(value, '') AS category FROM subjects LEFT JOIN category ON text = subject"""

ORACLE["attribute_rows"] = f"""WITH {DOC_CLAUSES},
{attribute_select(DOC_KEYS, 'v.doc_id, v.sentence_idx, v.clause_idx, v.sentence, v.clause_kma AS sentence_kma')} SELECT * FROM attributes"""
ORACLE["clause_sentiment"] = f"""WITH {DOC_CLAUSES}, {label_select(DOC_KEYS)}
SELECT doc_id, sentence_idx, clause_idx, clause_sentiment FROM labelled"""
ORACLE["clause_documents"] = f"""WITH {DOC_CLAUSES}, {label_select(DOC_KEYS)},
ids AS (SELECT *, concat_ws('_', doc_id, sentence_idx, clause_idx) AS id FROM labelled)
SELECT id, CAST(to_json({{'_index': 'emotion', '_type': 'analysis', '_id': id, '_source':
 {{'sentence': sentence, 'sentence_kma': clause_kma, 'sentiment': clause_sentiment}}}}) AS VARCHAR) AS document FROM ids"""
ORACLE["survey_attributes"] = f"""WITH {SURVEY_CHAIN},
{attribute_select(SURVEY_KEYS, 'v.case_id, v.response_id, v.answer_id, v.language_id, v.sentence_idx, v.clause_idx, v.content, v.clause')}
SELECT * REPLACE ({strip('content')} AS content) FROM attributes"""
ORACLE["survey_documents"] = f"""WITH {SURVEY_CHAIN}, {label_select(SURVEY_KEYS)},
ids AS (SELECT *, concat_ws('_', {SURVEY_KEYS}, clause_idx) AS id FROM labelled)
SELECT id, CAST(to_json({{'_index': 'emotion', '_type': 'analysis', '_id': id, '_source':
 {{'content': content, 'sentence': sentence, 'sentence_kma': clause_kma, 'sentiment': clause_sentiment}}}}) AS VARCHAR) AS document FROM ids"""

_FLAT = DOC_CLAUSES.replace("text AS content FROM documents", "replace(replace(text, chr(13), ''), chr(10), '') AS content FROM documents")
ORACLE["tagged_records"] = f"""WITH {_FLAT}, {attribute_select(DOC_KEYS, 'v.doc_id, v.sentence_idx, v.clause_idx')},
ids AS (SELECT *, concat_ws('_', doc_id, sentence_idx, clause_idx, attr_idx) AS id FROM attributes WHERE attr_idx IS NOT NULL)
SELECT id, '<DOCID>' || id || '<DATE>{W.RECORD_DATE}<CONTENT>' || content || subject || chr(9) || verb || chr(9) || sentiment || chr(9) || category AS record
FROM ids JOIN docs USING (doc_id)"""

ORACLE["payload_quality"] = f"WITH {PAYLOAD_CHAIN} SELECT doc_id, quality, content FROM checked"
ORACLE["ingested_records"] = ORACLE["payload_quality"]
ORACLE["corpus_lines"] = f"""WITH {PAYLOAD_CHAIN}
SELECT doc_id, CASE WHEN quality = 'ok' THEN regexp_replace(kma, '[{WS}+]', ' ', 'g') || ' ' ELSE '' END AS line FROM checked WHERE quality <> 'no_result'"""

ORACLE["cause_spans"] = f"""WITH {CAUSE_CHAIN} SELECT doc_id, replace(replace(c.content, chr(13), ''), chr(10), '') AS content, cause_idx, start, value, sentence AS matched_text, span
FROM spans JOIN docs c USING (doc_id)"""

ORACLE["cause_verbs"] = f"""WITH {CAUSE_CHAIN}, lexicon AS ({W.LEXICON}), verb_dict AS ({W.VERB_DICT}),
word_lists AS (
 SELECT doc_id, cause_idx, value, span,
  list_filter(string_split_regex(lower({kept('sentence')}), '[{WS}]+'), lambda w: w <> '') AS list FROM spans),
flat_words AS (SELECT doc_id, cause_idx, value, span, {listed('list', 'pos')} FROM word_lists),
offsets AS (
 SELECT *, coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id, cause_idx ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
 FROM flat_words),
analysed AS (
 SELECT o.doc_id, o.cause_idx, o.value, o.pos, k, o.piece AS word, coalesce(l.token_type, 'NNG') AS type,
  k = 0 AND coalesce(contains(l.piece, '/J_'), false) AS opens
 FROM offsets o LEFT JOIN lexicon l ON l.word = o.piece CROSS JOIN (VALUES (0), (1)) v(k)
 WHERE o.s >= 0 AND o.s < o.span AND o.s + length(o.piece) - 1 < o.span),
states AS (
 SELECT *, last_value(CASE WHEN opens THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id, cause_idx ORDER BY pos, k) AS state FROM analysed),
kept AS (
 SELECT *, CASE WHEN type IN ('VV', 'VA', 'XR') THEN word || '/' || type ELSE word END AS verb FROM states
 WHERE NOT opens AND k = 1 AND (state IS NULL OR state = pos) AND type IN ('VV', 'VA', 'XR', 'NNG')),
lasts AS (SELECT doc_id, cause_idx, value, verb, arg_max(word, pos) AS word, arg_max(type, pos) AS type, max(pos) AS pos FROM kept GROUP BY ALL),
{match_cte('emotion', 'lasts', 'word', EMOTIONS)}
SELECT a.doc_id, a.cause_idx, a.value, row_number() OVER (PARTITION BY a.doc_id, a.cause_idx ORDER BY a.pos) - 1 AS verb_idx, a.verb,
 coalesce(CASE WHEN a.type = 'NNG' THEN e.value ELSE d.emotion END, '') AS emotion,
 replace(replace(c.content, chr(13), ''), chr(10), '') AS content
FROM lasts a LEFT JOIN emotion e ON e.text = a.word
LEFT JOIN verb_dict d ON d.verb = a.word || CASE a.type WHEN 'XR' THEN '하다' ELSE '다' END JOIN docs c USING (doc_id)"""

ORACLE["xml_records"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(replace(text, chr(13), ''), chr(10), '') AS content,
 '"result":[]' AS payload FROM documents"""
ORACLE["charset_ingest"] = "SELECT concat_ws('|', doc_id, translate(text, 'aeiou', '가나다라마')) AS value FROM documents"
ORACLE["survey_scan"] = f"WITH {SURVEY} SELECT * FROM survey"
ORACLE["recursive_scan"] = f"""WITH {SURVEY}
SELECT case_id, response_id, answer_id, replace(replace(comment, chr(13), ' '), chr(10), ' ') AS comment, answer_id AS folder FROM survey"""
ORACLE["topic_columns"] = f"""WITH sheet AS (
 SELECT conv_id || '_' || turn AS row_key, replace(replace(text, chr(13), ''), chr(10), '') AS comment FROM conversations),
{tag_cte('sheet', 'row_key', 'comment', 's.row_key')},
lists AS (SELECT row_key, {TOPICS.format('sentence_kma')} AS list FROM tagged WHERE sentence_kma <> '')
SELECT row_key, unnest(range(len(list))) + 2 AS column_idx, unnest(list) AS topic FROM lists"""

# -- dictionaries above the size limits ------------------------------------------------------------------

DOCUMENT_WORDS = f"""SELECT DISTINCT unnest(list_filter(string_split_regex(lower({kept('text')}), '[{WS}]+'), lambda w: w <> '')) AS word FROM documents"""
LARGE_LEXICON = f"""SELECT word, CASE length(word) % 3 WHEN 0 THEN word || '/VV+다/EM' WHEN 1 THEN word || '/NNG+은/J_' ELSE word || '/MAG' END AS piece
 FROM ({DOCUMENT_WORDS})"""
SURVEY_ROW = "case_id, response_id, answer_id"
ORACLE["tag_tokens_large"] = f"""WITH {SURVEY}, {
    tag_cte('survey', SURVEY_ROW, 'comment', 's.case_id, s.response_id, s.answer_id').replace(W.LEXICON, LARGE_LEXICON)
} SELECT {SURVEY_ROW}, sentence_kma FROM tagged"""
ORACLE["content_words_large"] = f"""WITH {SURVEY}, {
    tag_cte('survey', SURVEY_ROW, 'comment', 's.case_id, s.response_id, s.answer_id').replace(W.LEXICON, LARGE_LEXICON)
},
typed AS (SELECT {SURVEY_ROW}, word_idx, w.piece AS word, CASE WHEN l.word IS NULL THEN 1 ELSE length(w.piece) % 3 END AS kind, l.word IS NOT NULL AS listed
 FROM flat_words w LEFT JOIN lexicon l ON l.word = w.piece),
content AS (
 SELECT {SURVEY_ROW}, string_agg(word, '' ORDER BY word_idx) FILTER (WHERE kind <> 0) AS glued,
  sum(length(word) + 1) - 1 AS n_chars, count(*) FILTER (WHERE kind = 1 AND listed) AS n_opening
 FROM typed GROUP BY {SURVEY_ROW})
SELECT {SURVEY_ROW}, coalesce(glued, '') AS content_word, CAST(coalesce(n_chars, 0) AS BIGINT) AS n_chars, coalesce(n_opening, 0) AS n_opening
FROM survey LEFT JOIN content USING ({SURVEY_ROW})"""
ORACLE["emotion_match_large"] = f"""WITH {SURVEY}, {
    match_cte('emotion', 'survey', 'comment', f"SELECT word AS key, 'e' || length(word) % 5 AS value, word AS words FROM ({DOCUMENT_WORDS})")
} SELECT {SURVEY_ROW}, coalesce(value, '') AS emotion FROM survey LEFT JOIN emotion ON text = comment"""
ORACLE["category_match_large"] = f"""WITH {SURVEY}, {
    match_cte('category', 'survey', 'comment',
              "SELECT source AS key, lang AS value, source || ' ' || lang || ' ' || split_part(text, chr(10), 1) AS words FROM documents")
} SELECT {SURVEY_ROW}, coalesce(value, '') AS category FROM survey LEFT JOIN category ON text = comment"""
ORACLE["dataset_match_large"] = f"""WITH {CRAWL},
items AS (SELECT item_id, string_split(trim({padded('text')}), ' ') AS w FROM benchmark),
rules AS (
 SELECT DISTINCT item_id, w[i] || ' ' || w[i + 1] AS pair, w[i + 2] AS word
 FROM (SELECT item_id, w, unnest(range(1, len(w) - 1)) AS i FROM items)),
lists AS (
 SELECT doc_id, string_split(trim({padded('doc_title')}), ' ') AS w FROM crawl
 UNION ALL SELECT doc_id, string_split(trim({padded('doc_content')}), ' ') FROM crawl),
words AS (SELECT DISTINCT doc_id, unnest(w) AS word FROM lists),
pairs AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM lists))
SELECT DISTINCT CAST(item_id AS BIGINT) AS dataset_seq, doc_id FROM rules JOIN pairs USING (pair) JOIN words USING (doc_id, word)"""

# -- the same records and sheets from other files ----------------------------------------------------------

ORACLE["xml_rooted_records"] = ORACLE["xml_records"]
ORACLE["positional_sheet"] = ORACLE["topic_columns"]
