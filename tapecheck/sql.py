"""DuckDB equivalents of the registered queries, over the given tables as views."""

from __future__ import annotations

from crowdtape.functions.text import ABBREVIATIONS, CAPITAL, ELLIPSIS, END_MARKS, INITIALS
from tapecheck.views import HOLIDAYS, LEXICON

POSTS = """
posts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id, ts, CAST(ts AS DATE) AS date,
         CAST(user_id AS VARCHAR) AS username,
         CAST(event_id % 17 AS INTEGER) AS retweets,
         CAST(floor(value) AS INTEGER) AS favorites
  FROM events)"""

ACTIVITY = """
activity AS (
  SELECT date, count(*) AS post_count,
         CAST(sum(retweets) AS BIGINT) AS sum_shares, CAST(sum(favorites) AS BIGINT) AS sum_likes
  FROM posts WHERE isodow(date) < 6 GROUP BY date)"""

OHLC = """
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, count(*) AS volume,
         arg_max(value, event_id) AS "adjClose" """

PRICES = f"""
prices AS (
  SELECT CAST(ts AS DATE) AS date, {OHLC}
  FROM events WHERE event_type = 'purchase' AND isodow(ts) < 6 GROUP BY CAST(ts AS DATE))"""

ORDER_PRICES = """
prices AS (
  SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_totalprice, o_orderkey) AS close
  FROM orders WHERE isodow(o_orderdate) < 6 GROUP BY CAST(o_orderdate AS DATE))"""

LABELS = """
labels_by_day AS (
  SELECT p.date, p.close AS price, q.close AS next_price,
         CASE WHEN p.close IS NULL OR q.close IS NULL THEN NULL
              WHEN q.close - p.close > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
  FROM prices p JOIN prices q
    ON p.date = CAST(q.date - to_days(CASE WHEN isodow(q.date) = 1 THEN 3 ELSE 1 END) AS DATE))"""

SAMPLE = """
sample AS (
  SELECT * FROM posts {where}
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY md5('7:' || id), id) <= 200)"""

EMOJI = r"[\p{So}+|\x{FE0F}]"
HANDLE = r"@[\w|_]+"
UNHANDLED = rf"regexp_replace(text, '{HANDLE}', '', 'g')"
CLEAN = rf"regexp_replace(regexp_replace(text, '{EMOJI}', '', 'g'), '{HANDLE}', '', 'g')"
SENTENCES = rf"list_filter(regexp_split_to_array({CLEAN}, '[.!?]+\s*|\n+'), lambda x: x <> '')"
IS_WORD = (
    r"regexp_matches(regexp_replace(x, '[\x{10000}-\x{10FFFF}]', '', 'g'), '[\p{L}\p{Nd}]')"
)


def _words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda x: {IS_WORD})"


GIVEN_LEXICON = "lexicon(token, polarity) AS (VALUES {})".format(
    ", ".join(f"('{token}', {polarity})" for token, polarity in LEXICON.items())
)


def _totals(source: str, key: str, lexicon: str = GIVEN_LEXICON) -> str:
    """CTEs that end in ``totals(key, total)`` for the texts of ``source``."""
    return f"""
{lexicon},
sentence_list AS (SELECT {key}, unnest({SENTENCES}) AS sentence FROM {source}),
sentence_rows AS (SELECT {key}, row_number() OVER () AS n, sentence FROM sentence_list),
word_rows AS (SELECT {key}, n, unnest({_words("sentence")}) AS word FROM sentence_rows),
classes AS (
  SELECT {key}, n, count(*) AS words,
         greatest(-2, least(2, sum(coalesce(polarity, 0)))) AS polarity
  FROM word_rows LEFT JOIN lexicon ON word = token GROUP BY {key}, n),
totals AS (SELECT {key}, sum(words * polarity) AS total FROM classes GROUP BY {key})"""


def _bucket(low: int, middle: int, high: int) -> str:
    return f"""CAST(CASE WHEN coalesce(total, 0) < -3 THEN {low}
       WHEN coalesce(total, 0) > 1 THEN {high} ELSE {middle} END AS DOUBLE)"""


def _document_sentiment(*buckets: int) -> str:
    return f"""WITH {_totals("documents", "doc_id")}
SELECT doc_id, {_bucket(*buckets)} AS sentiment FROM documents LEFT JOIN totals USING (doc_id)"""


ALL_POSTS = "sample AS (SELECT * FROM posts WHERE isodow(date) < 6)"

BY_DAY = f"""
texts AS (
  SELECT s.id, s.date, d.text FROM sample s
  JOIN documents d ON d.doc_id = s.event_id % (SELECT count(*) FROM documents)),
{_totals("texts", "id")},
sentiment_by_day AS (
  SELECT date, sum({_bucket(-1, 0, 1)}) AS total_sentiment
  FROM texts LEFT JOIN totals USING (id) GROUP BY date)"""

SENTIMENT = f"{ALL_POSTS}, {BY_DAY}"
CAPPED_SENTIMENT = f"{SAMPLE.format(where='WHERE isodow(date) < 6')}, {BY_DAY}"

CORPUS = """
corpus AS (
  SELECT CASE WHEN toxic = 1 THEN CAST(0 AS DOUBLE) WHEN quality = 1 THEN CAST(2 AS DOUBLE)
              ELSE CAST(1 AS DOUBLE) END AS label,
         text, CAST(doc_id AS VARCHAR) AS id
  FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND text <> '')"""

PREDICTIONS = """
predictions AS (
  SELECT CAST(ts AS DATE) AS date, CAST(event_id AS VARCHAR) AS id, props AS text,
         CAST(user_id % 3 AS DOUBLE) AS label,
         CAST(event_id % 3 AS DOUBLE) AS forest_prediction,
         CAST((event_id // 3) % 3 AS DOUBLE) AS perceptron_prediction,
         CAST(CAST(floor(value) AS BIGINT) % 3 AS DOUBLE) AS bayes_prediction
  FROM events),
voted AS (
  SELECT *, CASE
    WHEN forest_prediction IN (perceptron_prediction, bayes_prediction) THEN forest_prediction
    WHEN perceptron_prediction = bayes_prediction THEN perceptron_prediction
    ELSE CAST(1 AS DOUBLE) END AS prediction
  FROM predictions)"""

RAW_TEXT = """'"' || event_type || ';' || replace(props, '"', '""') || '"'"""


def _fold(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5('100:' || {key}), 1, 8) AS BIGINT) % 10 AS INTEGER)"


def _overlay_part(series: str, source: str, value: str) -> str:
    return f"""
SELECT '{series}' AS series, CAST(date AS VARCHAR) AS day,
       round(CASE WHEN sd IS NULL OR sd = 0 THEN CAST(0 AS DOUBLE) ELSE ({value} - mean) / sd END, 6)
         AS z
FROM {source}, (SELECT avg({value}) AS mean, stddev_samp({value}) AS sd FROM {source})"""


FEATURES_FULL = f"""WITH {POSTS}, {ACTIVITY}, {PRICES}, {LABELS}, {SENTIMENT}
SELECT * FROM activity JOIN labels_by_day USING (date) JOIN sentiment_by_day USING (date)"""

SHARED_IDS = f"""WITH {_totals("documents", "doc_id")}
SELECT nullif(doc_id % 50, 0) AS id, {_bucket(-1, 0, 1)} AS sentiment, count(*) AS posts
FROM documents LEFT JOIN totals USING (doc_id) GROUP BY ALL"""

ORACLE = {
    "parse_raw_posts": f"""
SELECT CAST(user_id AS VARCHAR) AS username, date_trunc('minute', ts) AS timestamp,
       CAST(ts AS DATE) AS date, CAST(event_id % 17 AS INTEGER) AS retweets,
       CAST(floor(value) AS INTEGER) AS favorites, {RAW_TEXT} AS text, '' AS geo,
       '@u' AS mentions, '#t' AS hashtags, CAST(event_id AS VARCHAR) AS id,
       'http://x/p' AS permalink
FROM events""",
    "parse_document_posts": r"""
SELECT source AS username, TIMESTAMP '2024-01-02 03:04:00' AS timestamp,
       DATE '2024-01-02' AS date, CAST(doc_id % 17 AS INTEGER) AS retweets,
       CAST(n_chars AS INTEGER) AS favorites, translate(text, chr(13) || chr(10), '  ') AS text,
       '' AS geo, '' AS mentions, lang AS hashtags, CAST(doc_id AS VARCHAR) AS id,
       'http://x/d' AS permalink
FROM documents""",
    "reject_report": """
SELECT CASE event_id % 4 WHEN 0 THEN 'bad time' WHEN 1 THEN 'bad retweets'
            WHEN 2 THEN 'bad id' ELSE 'missing fields' END AS reject_reason, count(*) AS rows
FROM events GROUP BY 1""",
    "dedupe_posts": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""",
    "labeled_corpus": f"WITH {CORPUS} SELECT * FROM corpus",
    "class_balance": f"WITH {CORPUS} SELECT label, count(*) AS rows FROM corpus GROUP BY label",
    "daily_ohlc": f"WITH {PRICES} SELECT * FROM prices",
    "trading_day_posts": f"""WITH {POSTS}
SELECT id, date, retweets, favorites FROM posts WHERE isodow(date) < 6""",
    "daily_activity": f"""WITH {POSTS}, {ACTIVITY}
SELECT date, post_count, sum_shares AS sum_retweets, sum_likes AS sum_favorites FROM activity""",
    "next_day_label_calendar": f"WITH {ORDER_PRICES}, {LABELS} SELECT * FROM labels_by_day",
    "next_day_label_next_row": f"""
WITH ticker_prices AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date, {OHLC}
  FROM events WHERE isodow(ts) < 6 GROUP BY event_type, CAST(ts AS DATE)),
paired AS (
  SELECT ticker, date, close AS price,
         lead(close) OVER (PARTITION BY ticker ORDER BY date) AS next_price
  FROM ticker_prices)
SELECT ticker, date, price, next_price,
       CASE WHEN next_price - price > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM paired WHERE next_price IS NOT NULL""",
    "features_no_sentiment": f"""WITH {POSTS}, {ACTIVITY}, {PRICES}, {LABELS}
SELECT * FROM activity JOIN labels_by_day USING (date)""",
    "features_long_history": f"""
WITH posts AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_linenumber AS retweets,
         CAST(l_quantity AS INTEGER) AS favorites
  FROM lineitem), {ACTIVITY}, {ORDER_PRICES}, {LABELS}
SELECT * FROM activity JOIN labels_by_day USING (date)""",
    "clean_text": f"SELECT doc_id, {CLEAN} AS clean FROM documents",
    "tokenize": f"""
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_tokens, array_to_string(words, ' ') AS tokens
FROM (SELECT doc_id, {_words(UNHANDLED)} AS words FROM documents)""",
    "sentence_split": f"""
SELECT doc_id, unnest(range(1, len(parts) + 1)) AS sentence_no, unnest(parts) AS sentence
FROM (SELECT doc_id, {SENTENCES} AS parts FROM documents)""",
    "cap_per_day": f"WITH {POSTS}, {SAMPLE.format(where='')} SELECT date, id, username FROM sample",
    "sentiment_signed": _document_sentiment(-1, 0, 1),
    "sentiment_class": _document_sentiment(0, 1, 2),
    "labeled_sentiment": f"""WITH {CORPUS}, {_totals("corpus", "id")}
SELECT id, label, {_bucket(0, 1, 2)} AS sentiment FROM corpus LEFT JOIN totals USING (id)""",
    "sentiment_broadcast": _document_sentiment(-1, 0, 1),
    "sentiment_salted": _document_sentiment(-1, 0, 1),
    "score_with_plugin": _document_sentiment(-1, 0, 1),
    "daily_sentiment": f"WITH {POSTS}, {SENTIMENT} SELECT * FROM sentiment_by_day",
    "daily_sentiment_capped": f"WITH {POSTS}, {CAPPED_SENTIMENT} SELECT * FROM sentiment_by_day",
    **dict.fromkeys(("shared_ids_inline", "shared_ids_broadcast", "shared_ids_salted"), SHARED_IDS),
    "cv_forest": "SELECT true AS is_share, CAST(10 AS INTEGER) AS folds",
    "fit_forest": f"""
WITH posts AS (SELECT CAST(l_shipdate AS DATE) AS date, 0 AS retweets, 0 AS favorites FROM lineitem),
{ACTIVITY}, {ORDER_PRICES}, {LABELS}
SELECT date, label, true AS in_classes FROM activity JOIN labels_by_day USING (date)""",
    "word2vec_features": f"""WITH {CORPUS}
SELECT id, label, CAST(50 AS INTEGER) AS dimensions, true AS in_range FROM corpus""",
    **dict.fromkeys(("fit_mlp", "fit_nb"), f"WITH {CORPUS} SELECT id, label, true AS in_classes FROM corpus"),
    "ensemble_predictions": f"""WITH {POSTS}
SELECT date, id, text, true AS is_majority
FROM posts JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents)""",
    "cv_direction": "SELECT true AS is_share, CAST(10 AS INTEGER) AS folds",
    "features_full": FEATURES_FULL,
    "load_or_build": FEATURES_FULL,
    "posts_per_day": f"""WITH {POSTS}
SELECT CAST(date AS VARCHAR) AS day, count(*) AS posts_per_day FROM posts GROUP BY date""",
    "price_per_day": f"WITH {PRICES} SELECT CAST(date AS VARCHAR) AS day, close AS price FROM prices",
    "normalized_overlay": f"""WITH {POSTS}, {PRICES},
per_day AS (SELECT date, count(*) AS n FROM posts GROUP BY date)
{_overlay_part("posts", "per_day", "n")} UNION ALL {_overlay_part("price", "prices", "close")}""",
    "step_counts": f"""
WITH {POSTS}, {ACTIVITY}, {PRICES}, {LABELS}, {SAMPLE.format(where="WHERE isodow(date) < 6")}
SELECT 'posts' AS step, count(*) AS rows FROM posts
UNION ALL SELECT 'active days', count(*) FROM activity
UNION ALL SELECT 'labelled days', count(*) FROM activity JOIN labels_by_day USING (date)
UNION ALL SELECT 'sampled posts', count(*) FROM sample""",
    "fold_assignment": f"SELECT o_orderkey, {_fold('o_orderkey')} AS fold FROM orders",
    "majority_vote": f"""WITH {PREDICTIONS}
SELECT id, forest_prediction, perceptron_prediction, bayes_prediction, prediction FROM voted""",
    "join_predictions": f"WITH {PREDICTIONS} SELECT * EXCLUDE (label) FROM voted",
    "confusion_matrix": f"""WITH {PREDICTIONS}
SELECT label, prediction, count(*) AS rows FROM voted GROUP BY label, prediction""",
    "accuracy": f"""WITH {PREDICTIONS}
SELECT round(avg(coalesce(CAST(label = prediction AS INTEGER), 0)), 9) AS accuracy FROM voted""",
    "weighted_recall": f"""WITH {PREDICTIONS},
per_label AS (
  SELECT label, count(*) AS n, avg(CAST(label = prediction AS INTEGER)) AS recall
  FROM voted GROUP BY label)
SELECT round(sum(n * recall) / sum(n), 9) AS weighted_recall FROM per_label""",
    "fold_recall": f"""WITH {PREDICTIONS},
per_label AS (
  SELECT {_fold("id")} AS fold, label, count(*) AS n,
         avg(CAST(label = prediction AS INTEGER)) AS recall
  FROM voted GROUP BY ALL),
per_fold AS (SELECT fold, sum(n * recall) / sum(n) AS recall FROM per_label GROUP BY fold)
SELECT round(avg(recall), 9) AS mean_recall, count(*) AS folds FROM per_fold""",
}

# A base and three deltas, the last of which repeats signups 40 days earlier.
DELIVERED = f"""
delivered AS (
  SELECT CAST(user_id AS VARCHAR) AS username,
         date_trunc('minute', CASE WHEN event_type = 'signup' THEN ts - to_days(40) ELSE ts END) AS timestamp,
         CAST(CASE WHEN event_type = 'signup' THEN ts - to_days(40) ELSE ts END AS DATE) AS date,
         CAST(event_id % 17 AS INTEGER) AS retweets, CAST(floor(value) AS INTEGER) AS favorites,
         {RAW_TEXT} AS text, '' AS geo, '@u' AS mentions, '#t' AS hashtags,
         CAST(event_id AS VARCHAR) AS id, 'http://x/p' AS permalink
  FROM events)"""

ORACLE |= {
    "incremental_posts": f"WITH {DELIVERED} SELECT * FROM delivered",
    "stored_days": f"""WITH {DELIVERED}
SELECT id, date, retweets, favorites FROM delivered
WHERE date BETWEEN DATE '2023-12-10' AND DATE '2024-01-15'""",
    "incremental_activity": f"""WITH {DELIVERED},
daily AS (
  SELECT date, count(*) AS post_count, CAST(sum(retweets) AS BIGINT) AS sum_shares,
         CAST(sum(favorites) AS BIGINT) AS sum_likes, round(stddev_samp(favorites), 6) AS likes_sd
  FROM delivered GROUP BY date)
SELECT *, round(coalesce((post_count - (SELECT avg(post_count) FROM daily))
         / nullif((SELECT stddev_samp(post_count) FROM daily), 0), 0), 6) AS z FROM daily""",
    "incremental_sentiment": ORACLE["daily_sentiment"],
    "observed_counts": f"""
WITH {POSTS}, {ACTIVITY}, {PRICES}, {LABELS}, {SENTIMENT}
SELECT 'trading day posts' AS step, count(*) AS rows FROM posts WHERE isodow(date) < 6
UNION ALL SELECT 'active days', count(*) FROM activity
UNION ALL SELECT 'labelled days', count(*) FROM labels_by_day
UNION ALL SELECT 'scored posts', count(*) FROM sample
UNION ALL SELECT 'feature days', count(*)
FROM activity JOIN labels_by_day USING (date) JOIN sentiment_by_day USING (date)""",
}

SESSIONS = f"""
sessions AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
  WHERE isodow(o_orderdate) < 6 AND strftime(o_orderdate, '%m-%d') NOT IN {HOLIDAYS})"""

SESSION_PRICES = f"""{ORDER_PRICES}, {SESSIONS},
known AS (SELECT * FROM prices WHERE close IS NOT NULL AND date IN (SELECT date FROM sessions)),
by_session AS (
  SELECT a.date, a.close AS price, b.close AS next_price,
         CASE WHEN b.close - a.close > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
  FROM known a ASOF JOIN known b ON a.date < b.date)"""

# Terms of the labelled posts by the text's id, the fold of each post, and the model of four folds.
TERMS = f"""
folds AS (SELECT *, CAST(CAST('0x' || substr(md5('100:' || id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM corpus),
sentence_texts AS (SELECT id, label, fold, unnest({SENTENCES}) AS sentence FROM folds),
terms AS (SELECT id, label, fold, unnest({_words("sentence")}) AS term FROM sentence_texts)"""

BAYES = f"""WITH {CORPUS}, {TERMS},
class_rows AS (SELECT label, count(*) AS n FROM folds WHERE fold <> 0 GROUP BY label),
priors AS (
  SELECT label, ln((n + 1.0::DOUBLE) / ((SELECT sum(n) FROM class_rows) + (SELECT count(*) FROM class_rows))) AS prior
  FROM class_rows),
counts AS (SELECT term, label, count(*) AS n FROM terms WHERE fold <> 0 GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM counts),
class_terms AS (SELECT label, sum(n) AS n FROM counts GROUP BY label),
weights AS (
  SELECT v.term, c.label,
         ln((coalesce(k.n, 0) + 1.0::DOUBLE) / (c.n + (SELECT count(*) FROM vocabulary))) AS weight
  FROM vocabulary v CROSS JOIN class_terms c LEFT JOIN counts k ON k.term = v.term AND k.label = c.label),
sums AS (SELECT t.id, w.label, sum(w.weight) AS total FROM terms t JOIN weights w USING (term) GROUP BY ALL),
scores AS (
  SELECT f.id, p.label AS class, round(p.prior + coalesce(s.total, 0), 6) AS score
  FROM folds f CROSS JOIN priors p LEFT JOIN sums s ON s.id = f.id AND s.label = p.label),
predicted AS (
  SELECT id, class AS prediction FROM scores
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, class) = 1)"""

LEARNED = f"""{CORPUS}, {TERMS},
held AS (
  SELECT term AS token, count(DISTINCT id) AS n, count(DISTINCT id) FILTER (label = 2) AS p,
         count(DISTINCT id) FILTER (label = 0) AS m
  FROM terms WHERE fold <> 0 GROUP BY term),
weighted AS (
  SELECT *, 100.0::DOUBLE * n / (SELECT sum(n) FROM held) AS w, (SELECT sum(p) FROM held) AS tp,
         (SELECT sum(m) FROM held) AS tm
  FROM held),
scored_tokens AS (
  SELECT token, (ln((p + w) / (tp + 100.0::DOUBLE - p - w)) - ln((m + w) / (tm + 100.0::DOUBLE - m - w)))
         / sqrt(1 / (p + w) + 1 / (m + w)) AS z
  FROM weighted),
lexicon AS (
  SELECT token, CAST(sign(z) * CASE WHEN abs(z) >= 3.92 THEN 2 ELSE 1 END AS INTEGER) AS polarity, z
  FROM scored_tokens WHERE abs(z) >= 1.96)"""

LEARNED_CLASSES = f"""WITH {_totals("corpus", "id", LEARNED)},
classed AS (
  SELECT f.id, f.label, f.fold, {_bucket(0, 1, 2)} AS sentiment
  FROM folds f LEFT JOIN totals t ON t.id = f.id)"""


def _agreement(source: str, prediction: str) -> str:
    return f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, round(sum(hits) / sum(n), 9) AS accuracy, round(max(n) / sum(n), 9) AS majority
FROM (SELECT label, count(*) AS n, count(*) FILTER (label = {prediction}) AS hits FROM {source} GROUP BY label)"""


ORACLE |= {
    "session_labels": f"""WITH {SESSION_PRICES}
SELECT d.date, d.post_count, p.close AS price, p.date AS price_date, n.close AS next_price, n.date AS next_date,
       CASE WHEN p.close IS NULL OR n.close IS NULL THEN NULL
            WHEN n.close - p.close > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS post_count FROM lineitem GROUP BY 1) d
ASOF LEFT JOIN known p ON d.date >= p.date ASOF LEFT JOIN known n ON d.date < n.date""",
    "features_by_session": f"""
WITH posts AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_linenumber AS retweets, CAST(l_quantity AS INTEGER) AS favorites
  FROM lineitem), {SESSION_PRICES}
SELECT date, count(*) AS post_count, CAST(sum(retweets) AS BIGINT) AS sum_shares,
       CAST(sum(favorites) AS BIGINT) AS sum_likes, price, next_price, label
FROM posts JOIN by_session USING (date) GROUP BY ALL""",
    "term_bayes": f"{BAYES} SELECT id, label, fold, prediction FROM folds JOIN predicted USING (id)",
    "term_bayes_accuracy": BAYES
    + ", unseen AS (SELECT label, prediction FROM folds JOIN predicted USING (id) WHERE fold = 0)"
    + _agreement("unseen", "prediction"),
    "learned_lexicon": f"WITH {LEARNED} SELECT token, polarity, round(z, 6) AS z FROM lexicon",
    "learned_sentiment": f"{LEARNED_CLASSES} SELECT * FROM classed",
    "learned_sentiment_accuracy": f"""{LEARNED_CLASSES}, unseen AS (SELECT * FROM classed WHERE fold = 0)
{_agreement("unseen", "sentiment")}""",
}

def _pattern(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ENDS = f"""regexp_matches(w, {_pattern(END_MARKS)}) AND lower(w) NOT IN {ABBREVIATIONS}
  AND NOT regexp_matches(w, {_pattern(INITIALS)})
  AND (NOT regexp_matches(w, {_pattern(ELLIPSIS)}) OR regexp_matches(coalesce(words[i + 1], ''), {_pattern(CAPITAL)}))"""

ORACLE["sentence_rules"] = rf"""
WITH line_lists AS (
  SELECT doc_id, regexp_split_to_array(translate(text, chr(1), ''), '\n+') AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM line_lists),
worded AS (
  SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '[ \t\r\x0B\f]+'), lambda w: w <> '') AS words
  FROM numbered),
marked AS (
  SELECT doc_id, line_no, array_to_string(list_transform(words, lambda w, i:
    CASE WHEN {ENDS} THEN w || chr(1) ELSE w END), ' ') AS line
  FROM worded),
wholes AS (SELECT doc_id, string_agg(coalesce(line, ''), chr(1) ORDER BY line_no) AS whole FROM marked GROUP BY doc_id),
found AS (
  SELECT doc_id, list_filter(list_transform(string_split(whole, chr(1)), lambda x: trim(x, ' ')), lambda x: x <> '') AS parts
  FROM wholes)
SELECT doc_id, unnest(range(1, len(parts) + 1)) AS sentence_no, unnest(parts) AS sentence FROM found"""

SHIFTED = " UNION ALL ".join(
    f"SELECT word, lead(word, {gap}) OVER (PARTITION BY n ORDER BY place) AS context FROM placed" for gap in range(1, 6)
)

ORACLE["pmi_table"] = f"""WITH {CORPUS},
token_lists AS (SELECT row_number() OVER () AS n, {_words(UNHANDLED)} AS words FROM corpus),
placed AS (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS place FROM token_lists),
shifted AS ({SHIFTED}),
ahead AS (SELECT word, context, count(*) AS n FROM shifted WHERE context IS NOT NULL GROUP BY ALL),
pairs AS (
  SELECT word, context, sum(n) AS n
  FROM (SELECT * FROM ahead UNION ALL SELECT context, word, n FROM ahead) GROUP BY ALL),
totals AS (SELECT word, sum(n) AS total FROM pairs GROUP BY word),
scored AS (
  SELECT p.word, p.context,
         ln((CAST(p.n AS DOUBLE) / w.total) * (CAST((SELECT sum(total) FROM totals) AS DOUBLE) / c.total)) AS pmi
  FROM pairs p JOIN totals w ON w.word = p.word JOIN totals c ON c.word = p.context WHERE p.n >= 5)
SELECT word, context, round(pmi, 6) AS pmi FROM scored WHERE pmi > 0"""

# Files that are written and read again hold what went into them.
ORACLE |= {
    "read_raw_files": ORACLE["parse_raw_posts"],
    "labeled_file": ORACLE["labeled_corpus"],
    "read_price_file": ORACLE["daily_ohlc"],
    "export_series": ORACLE["price_per_day"],
}
