"""DuckDB SQL with the same result as each query of the catalogue.

Tokens, places, votes and so on are spelled out in SQL; only the fixture values
and the text patterns are shared with the Spark side.
"""

from __future__ import annotations

from feedlens.functions.redact import KINDS, RULES
from feedlens.functions.text import EMOJI, URL, WHITESPACE, WORD
from feedlens.plans import testtables as tt

ORACLES: dict[str, str] = {}


def _q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    def one(v) -> str:
        return _q(v) if v is None or isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


EPOCH = f"TIMESTAMP '{tt.EPOCH}'"
SCRAPED = f"TIMESTAMP '{tt.SCRAPED_AT}'"


def _country(lang: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in tt.COUNTRY_OF_LANG.items())
    return f"CASE {lang} {cases} END"


# message views -----------------------------------------------------------------

DOCS = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id_, doc_id AS num, {EPOCH} + to_hours(doc_id % {tt.HOURS}) AS datetime_,
         {_country("lang")} AS country, 'documents' AS source, source AS channel, text, lang, n_chars
  FROM documents)"""
CONV = f"""conv AS (
  SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id_, conv_id * 1000 + turn AS num,
         {EPOCH} + to_hours(conv_id % {tt.HOURS}) + to_minutes(turn) AS datetime_, 'NLD' AS country,
         'conversations' AS source, 'conv_' || conv_id AS channel, text, turn > 0 AS reply,
         CASE WHEN turn > 0 THEN CAST(conv_id * 1000 + turn - 1 AS VARCHAR) END AS reply_to
  FROM conversations)"""
EVENTS = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS id_, event_id AS num, ts AS datetime_,
         (['GBR', 'DEU', 'FRA', 'ESP'])[user_id % 4 + 1] AS country, 'events' AS source,
         event_type AS channel, props AS text, user_id,
         (user_id % 36) * 10 - 180 + CAST(0.25 AS DOUBLE) AS lon, value % CAST(90 AS DOUBLE) AS lat
  FROM events)"""
PAGES = f"""pg AS (
  SELECT CAST(page_id AS VARCHAR) AS id_, page_id AS num, {EPOCH} + to_hours(page_id % {tt.HOURS}) AS datetime_,
         {_country("regexp_extract(url, '^https?://[^/]+/(en|de|fr)/', 1)")} AS country, 'pages' AS source,
         regexp_extract(url, '^https?://([^/?#]+)', 1) AS channel,
         regexp_extract(html, '<title>([^<]*)</title>', 1) || ' ' || url AS text
  FROM pages)"""
PAGE_BODIES = PAGES.replace("|| url AS text", "|| url || ' ' || regexp_replace(html, '<[^>]*>', ' ', 'g') AS text")
RAW = f"""rawc AS (
  SELECT c.conv_id * 1000 + c.turn AS id, {EPOCH} + to_hours(c.conv_id % {tt.HOURS}) + to_minutes(c.turn) AS date,
         c.text AS message, 'conv_' || c.conv_id AS channel, c.turn % 2 = 0 AS top,
         CASE WHEN c.turn % 2 = 1 THEN c.conv_id * 1000 + c.turn - 1 END AS parent,
         c.role <> 'system' AS post, n.turn IS NOT NULL AS answered, c.conv_id % 3 <> 0 AS broadcast
  FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1)"""

# lookups -------------------------------------------------------------------------

STOP = "stop(lang, word) AS (VALUES " + _values([(k, w) for k, t in tt.STOPWORDS.items() for w in t.split()]) + ")"
LEMMAS = f"lemmas(word, lemma) AS (VALUES {_values(list(tt.LEMMAS.items()))})"
PLACES = f"places(loc_id, name, name_alt, lon, lat) AS (VALUES {_values(tt.GAZETTEER)})"
EDGES = "edges(region_id, name, x1, y1, x2, y2) AS (VALUES " + _values(
    [(r, n, *p, *ring[(i + 1) % len(ring)]) for r, n, ring in tt.REGIONS for i, p in enumerate(ring)]
) + ")"
TERMS = "terms(ix, label, term) AS (VALUES " + _values(
    [(i, label, t) for i, label in enumerate(tt.LABELS) for t in tt.LABEL_TERMS[label]]
) + ")"
POLARITY = f"polarity(word, sign) AS (VALUES {_values(list(tt.POLARITY.items()))})"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g')"


def _words(text: str) -> str:
    bare = f"regexp_replace(lower({text}), '[^{WORD}{WHITESPACE}]', '', 'g')"
    return f"list_filter(string_split_regex({bare}, '[{WHITESPACE}]+'), lambda w: w <> '')"


def _clean(text: str) -> str:
    out = f"regexp_replace({text}, '[\\r\\n]+', ' ', 'g')"
    out = f"regexp_replace({out}, {_q(URL)}, '<URL>', 'g')"
    out = f"regexp_replace({out}, {_q(EMOJI)}, '', 'g')"
    return _strip(f"regexp_replace({out}, '[{WHITESPACE}]+', ' ', 'g')")


def _redact(text: str) -> str:
    for pattern, replacement in RULES.values():
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return text


def _oracle(name: str, body: str, *parts: str) -> None:
    ORACLES[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


TOKENS = f"tokens AS (SELECT id_, country, unnest({_words('text')}) AS word FROM docs)"
VOTES = """votes AS (
  SELECT id_, lang, count(*) AS n FROM tokens JOIN stop USING (word) GROUP BY ALL),
detected AS (
  SELECT id_, arg_min(lang, (-n, lang)) AS detected_lang FROM votes GROUP BY id_)"""
LANGUAGE = (STOP, TOKENS, VOTES)


def _replaced(lang: str) -> str:
    branches = []
    for code, entries in tt.LEXICON.items():
        cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in entries.items())
        one = f"list_transform(string_split(text, ' '), lambda w: CASE lower(w) {cases} ELSE w END)"
        branches.append(f"WHEN {_q(code)} THEN array_to_string({one}, ' ')")
    return f"CASE {lang} {' '.join(branches)} ELSE text END"


TRANSLATED = f"""translated AS (
  SELECT docs.*, coalesce(detected_lang, '') AS from_lang, {_replaced("detected_lang")} AS new_text
  FROM docs LEFT JOIN detected USING (id_))"""
SCORES = """hits AS (
  SELECT id_, ix, count(DISTINCT word) AS n
  FROM tokens JOIN terms ON word = term GROUP BY ALL),
scores AS (
  SELECT docs.id_, l.ix, l.label AS topic, coalesce(hits.n, 0) / CAST(l.size AS DOUBLE) AS score
  FROM docs CROSS JOIN (SELECT ix, label, count(*) AS size FROM terms GROUP BY ALL) l
  LEFT JOIN hits ON hits.id_ = docs.id_ AND hits.ix = l.ix),
best AS (
  SELECT id_, arg_min(topic, (-score, ix)) AS topic, max(score) AS score FROM scores GROUP BY id_)"""

# scans -----------------------------------------------------------------------------

_oracle(
    "scan_channel_messages",
    """SELECT id_, datetime_, 'GBR' AS country, 'Telegram' AS source, channel, text, false AS reply,
              count_all AS group_members
       FROM docs JOIN (SELECT source AS channel, count(*) AS count_all FROM documents GROUP BY 1) USING (channel)
       WHERE datetime_ >= TIMESTAMP '2024-01-08' AND text <> ''""",
    DOCS,
)
_oracle(
    "scan_posts_with_replies",
    """SELECT CAST(id AS VARCHAR) AS id_, date AS datetime_, channel, message AS text, NOT top AS reply,
              CAST(parent AS VARCHAR) AS reply_to
       FROM recent r WHERE message <> '' AND (top OR NOT broadcast OR EXISTS (
         SELECT 1 FROM recent p WHERE p.channel = r.channel AND p.id = r.parent
         AND p.top AND p.post AND p.answered AND p.broadcast))""",
    RAW,
    "recent AS (SELECT * FROM rawc WHERE date >= TIMESTAMP '2024-01-02')",
)
_oracle(
    "scan_user_timeline",
    """SELECT CAST(event_id AS VARCHAR) AS id_, ts AS datetime_, 'user_' || user_id AS channel, props AS text
       FROM events WHERE event_type <> 'error'
       AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
_oracle(
    "scan_search_queries",
    f"""SELECT id_, datetime_, channel, text FROM docs
        WHERE EXISTS (SELECT 1 FROM benchmark b WHERE contains(lower(docs.text), {_strip("lower(b.text)")}))""",
    DOCS,
)
_oracle(
    "scan_form_submissions",
    """SELECT id_, datetime_, 'UKR' AS country, 'Kobo' AS source, channel, text, 'asset-1' AS kobo_asset FROM docs""",
    DOCS,
)
_oracle(
    "scan_bad_input",
    """SELECT channel, count(*) AS records, CAST(sum(good) AS BIGINT) AS good, CAST(sum(bad) AS BIGINT) AS malformed,
              CAST(sum(1 - good - bad) AS BIGINT) AS empty
       FROM (SELECT coalesce(source, 'none') AS channel, CAST(doc_id % 10 IN (3, 7) AS INTEGER) AS bad,
                    CAST(doc_id % 10 NOT IN (3, 5, 7) AND coalesce(text, '') <> '' AS INTEGER) AS good
             FROM documents) GROUP BY 1""",
)
_oracle(
    "label_lookup",
    """SELECT doc_id, label FROM documents JOIN (
         SELECT source AS label, row_number() OVER (ORDER BY source) - 1 AS ix
         FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)) ON doc_id % 3 = ix""",
)
_oracle(
    "nan_coordinates",
    """SELECT id_, CASE WHEN channel <> 'error' THEN CAST(0.25 AS DOUBLE) END AS lon,
              CASE WHEN channel <> 'error' THEN round(lat, 6) END AS lat FROM ev""",
    EVENTS,
)
_oracle(
    "snapshot_round_trip",
    "SELECT id_, datetime_, country, channel, text FROM docs",
    DOCS,
)
_oracle(
    "normalize_messages",
    f"""SELECT CAST(id AS VARCHAR) AS id_, date AS datetime_, {SCRAPED} AS datetime_scraped_, 'NLD' AS country,
               'Telegram' AS source, channel, message AS text, NOT top AS reply,
               CAST(parent AS VARCHAR) AS reply_to, members AS group_members, CAST(0 AS BIGINT) AS translations
        FROM rawc JOIN (SELECT channel, count(*) AS members FROM rawc GROUP BY 1) USING (channel)""",
    RAW,
)
_oracle(
    "csv_round_trip",
    """SELECT id_, datetime_, country, channel, text, false AS reply,
              CAST(lang <> 'en' AS BIGINT) AS translations,
              CASE WHEN lang <> 'en' THEN reverse(text) ELSE '' END AS translated FROM docs""",
    DOCS,
)
ORACLES["csv_in_ranges"] = ORACLES["csv_round_trip"]
_oracle(
    "scan_store_required_filters",
    """SELECT id_, datetime_, country, source, channel, text FROM docs WHERE country = 'FRA'
       AND datetime_ BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 05:00:00'""",
    DOCS,
)
_oracle(
    "scan_store_optional_filters",
    """SELECT id_, datetime_, country, source, channel, text, reply, reply_to FROM conv
       WHERE datetime_ <= TIMESTAMP '2024-01-15 08:00:00'""",
    CONV,
)

# filters, bounds, counts --------------------------------------------------------------

_oracle("filter_min_length", "SELECT id_, text, length(text) AS n FROM docs WHERE length(text) >= 20", DOCS)
_oracle(
    "filter_since",
    "SELECT id_, datetime_, country FROM ev WHERE datetime_ >= TIMESTAMP '2024-01-16 00:00:00'",
    EVENTS,
)
_BOTH = """both_ AS (
  SELECT id_, num, datetime_, country, source, channel, text FROM docs
  UNION ALL SELECT id_, num, datetime_, country, source, channel, text FROM pg)"""
_oracle(
    "null_guard_counts",
    """SELECT count(*) FILTER (datetime_ IS NULL) AS null_datetime, count(*) FILTER (country IS NULL) AS null_country,
              count(*) FILTER (source IS NULL) AS null_source FROM both_""",
    DOCS, PAGES, _BOTH,
)
_oracle(
    "batch_bounds",
    """SELECT country, source, min(datetime_) AS min_datetime, max(datetime_) AS max_datetime
       FROM (SELECT country, source, datetime_ FROM docs UNION ALL SELECT country, source, datetime_ FROM ev)
       GROUP BY ALL""",
    DOCS, EVENTS,
)
_oracle("channel_counts", "SELECT source, channel, count(*) AS messages FROM both_ GROUP BY ALL", DOCS, PAGES, _BOTH)

# dedupe, insert, upsert -----------------------------------------------------------------

_oracle(
    "dedupe_by_id",
    """SELECT id_, source, datetime_, text FROM (
         SELECT * FROM both_ UNION ALL SELECT id_, num, datetime_, country, source, channel, text FROM conv)
       QUALIFY row_number() OVER (PARTITION BY id_ ORDER BY datetime_, source) = 1""",
    DOCS, PAGE_BODIES, CONV, _BOTH,
)
_oracle(
    "dedupe_by_text",
    "SELECT id_, text FROM docs QUALIFY row_number() OVER (PARTITION BY text ORDER BY datetime_, num) = 1",
    DOCS,
)
_SPLIT = """stored AS (SELECT * FROM ev WHERE datetime_ < TIMESTAMP '2024-01-20' AND country <> 'ESP'),
again AS (SELECT * FROM ev WHERE datetime_ >= TIMESTAMP '2024-01-11'),
incoming AS (SELECT * FROM again UNION ALL SELECT * FROM again WHERE channel = 'error')"""
_FLAT = "id_, datetime_, country, source, channel, text"
_oracle(
    "insert_new_only",
    f"SELECT DISTINCT {_FLAT} FROM incoming WHERE id_ NOT IN (SELECT id_ FROM stored)",
    EVENTS, _SPLIT,
)
_oracle(
    "insert_new_strict",
    f"""SELECT {_FLAT} FROM incoming WHERE country = 'ESP'
        UNION ALL SELECT {_FLAT} FROM incoming WHERE country <> 'ESP' AND channel <> 'error'
        AND id_ NOT IN (SELECT id_ FROM stored)""",
    EVENTS, _SPLIT,
)
_oracle(
    "insert_new_counts",
    """SELECT source, count(*) AS offered,
              count(DISTINCT CASE WHEN id_ NOT IN (SELECT id_ FROM stored) THEN id_ END) AS inserted,
              count(*) - count(DISTINCT CASE WHEN id_ NOT IN (SELECT id_ FROM stored) THEN id_ END) AS duplicates
       FROM incoming GROUP BY source""",
    EVENTS, _SPLIT,
)
_oracle(
    "upsert_by_id",
    f"""SELECT id_, datetime_,
               {SCRAPED} + CASE WHEN edited THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS datetime_scraped_,
               country, channel, CASE WHEN edited THEN 'edited ' || text ELSE text END AS text
        FROM (SELECT *, channel = 'error' AND datetime_ >= TIMESTAMP '2024-01-11' AS edited FROM ev
              WHERE id_ IN (SELECT id_ FROM stored) OR id_ IN (SELECT id_ FROM again))""",
    EVENTS, _SPLIT,
)
_oracle(
    "message_json",
    """SELECT id_, CAST(to_json({
         'id': id_, 'datetime_': strftime(datetime_, '%Y-%m-%dT%H:%M:%S'),
         'datetime_scraped_': '2024-02-01T12:00:00', 'country': country, 'source': source, 'group': channel,
         'text': text, 'reply': false, 'reply_to': CAST(NULL AS VARCHAR),
         'translations': CASE WHEN lang <> 'en'
            THEN [{'text': reverse(text), 'from_lang': lang, 'to_lang': 'en'}] ELSE [] END,
         'info': {'group_members': CAST(NULL AS BIGINT), 'coordinates': CAST(NULL AS BIGINT),
                  'locations': CAST(NULL AS BIGINT), 'extra': CAST(NULL AS BIGINT)},
         'classifications': CAST([] AS VARCHAR[])}) AS VARCHAR) AS json
       FROM docs""",
    DOCS,
)
_oracle(
    "message_diff",
    f"""SELECT 'datetime_' AS field, count(*) FILTER (both_sides AND l.datetime_ IS DISTINCT FROM r.datetime_) AS differing FROM joined
        UNION ALL SELECT 'country', count(*) FILTER (both_sides AND l.country IS DISTINCT FROM r.country) FROM joined
        UNION ALL SELECT 'group', count(*) FILTER (both_sides AND l.channel IS DISTINCT FROM r.channel) FROM joined
        UNION ALL SELECT 'text', count(*) FILTER (both_sides AND l.text IS DISTINCT FROM r.text) FROM joined
        UNION ALL SELECT 'reply_to', 0
        UNION ALL SELECT '(left only)', count(*) FILTER (r.id_ IS NULL) FROM joined
        UNION ALL SELECT '(right only)', count(*) FILTER (l.id_ IS NULL) FROM joined""",
    DOCS, CONV,
    f"""reloaded AS (
      SELECT id_, datetime_, country, source, channel, {_clean("text")} AS text FROM docs WHERE length(text) >= 200
      UNION ALL SELECT id_, datetime_, country, source, channel, text FROM conv)""",
    """original AS (SELECT id_, datetime_, country, source, channel, text FROM docs)""",
    """joined AS (SELECT l, r, l.id_ IS NOT NULL AND r.id_ IS NOT NULL AS both_sides
       FROM original l FULL JOIN reloaded r ON l.source = r.source AND l.id_ = r.id_)""",
)
_oracle(
    "thread_reply_counts",
    """SELECT c.id_, c.channel, c.datetime_, count(r.id_) AS replies, max(r.datetime_) AS last_reply
       FROM conv c LEFT JOIN conv r ON r.reply AND r.reply_to = c.id_ AND r.channel = c.channel
       GROUP BY ALL""",
    CONV,
)

# words ------------------------------------------------------------------------------------


def _frequency(by: str = "", lemmas: bool = True, where: str = "true", stop: str = "SELECT word FROM stop") -> str:
    lemma = "coalesce(lemma, word)" if lemmas else "word"
    join = "LEFT JOIN lemmas USING (word)" if lemmas else ""
    return f"""SELECT {by} regexp_replace(w, '\\.$', '') AS word, count(*) AS frequency
      FROM (SELECT {by} {lemma} AS w FROM tokens {join} WHERE {where})
      WHERE w NOT IN ({stop}) AND NOT regexp_matches(w, '^\\p{{N}}+$') GROUP BY ALL"""


_oracle("word_frequency", _frequency(), DOCS, TOKENS, STOP, LEMMAS)
_oracle("word_frequency_by_country", _frequency("country,", lemmas=False), DOCS, TOKENS, STOP)
_oracle(
    "word_frequency_topk",
    f"SELECT * FROM ({_frequency()}) ORDER BY frequency DESC, word LIMIT 50",
    DOCS, TOKENS, STOP, LEMMAS,
)
_oracle(
    "word_frequency_translated",
    f"""SELECT word, frequency, CASE word WHEN 'der' THEN 'the' WHEN 'und' THEN 'and' ELSE word END AS translation
        FROM ({_frequency(where="country = 'DEU'", stop="''")})""",
    DOCS, TOKENS, LEMMAS,
)
_oracle(
    "lemma_lookup",
    """SELECT word, count(*) AS frequency, coalesce(any_value(lemma), word) AS lemma
       FROM tokens LEFT JOIN lemmas USING (word) GROUP BY word""",
    DOCS, TOKENS, LEMMAS,
)
_WITH_KEYWORD = f"""contains(lower(text), 'with the')
  OR regexp_matches(lower(text), '(^|[^{WORD}])(with|nicht)($|[^{WORD}])')"""
_oracle("keyword_flag", f"SELECT id_, {_WITH_KEYWORD} AS keyword_flag FROM docs", DOCS)
_oracle(
    "keyword_flag_joined",
    f"""SELECT id_, {_WITH_KEYWORD}
          OR EXISTS (SELECT 1 FROM benchmark b WHERE contains(lower(docs.text), lower(b.text))) AS keyword_flag
        FROM docs""",
    DOCS,
)
_oracle("clean_text", f"SELECT source, id_, {_clean('text')} AS cleaned FROM both_", DOCS, PAGE_BODIES, _BOTH)
_oracle(
    "detect_language", "SELECT id_, detected_lang FROM docs LEFT JOIN detected USING (id_)", DOCS, *LANGUAGE
)
ORACLES["detect_language_joined"] = ORACLES["detect_language"]
_oracle(
    "detect_language_accuracy",
    "SELECT lang, detected_lang, count(*) AS messages FROM docs LEFT JOIN detected USING (id_) GROUP BY ALL",
    DOCS, *LANGUAGE,
)

# translation ----------------------------------------------------------------------------------

_oracle(
    "translate_lexicon",
    "SELECT id_, CAST(0 AS BIGINT) AS ix, from_lang, 'en' AS to_lang, new_text AS text FROM translated",
    DOCS, *LANGUAGE, TRANSLATED,
)
ORACLES["translate_lexicon_joined"] = ORACLES["translate_lexicon"]
_oracle(
    "translate_udf",
    "SELECT id_, CAST(0 AS BIGINT) AS ix, 'xx' AS from_lang, 'en' AS to_lang, reverse(text) AS text FROM docs",
    DOCS,
)
_oracle(
    "classify_trained_form",
    """SELECT CAST(doc_id AS VARCHAR) AS id_, CAST(2 AS BIGINT) AS entries, CAST(1 AS DOUBLE) AS total, 'bad,good' AS topics
       FROM documents WHERE text IS NOT NULL""",
)
_oracle(
    "translate_udf_failures",
    """SELECT id_, CASE WHEN length(text) % 97 = 0 THEN 1 ELSE 0 END AS failed,
              CASE WHEN length(text) % 97 = 0 THEN text ELSE reverse(text) END AS text FROM docs""",
    DOCS,
)
_oracle(
    "translation_upsert",
    """SELECT id_, CAST(0 AS BIGINT) AS ix, CASE lang WHEN 'en' THEN 'fr' ELSE lang END AS from_lang, 'en' AS to_lang,
              CASE WHEN lang IN ('en', 'fr') THEN 'NEW ' || text ELSE reverse(text) END AS text FROM docs
       UNION ALL SELECT id_, 1, 'fr', 'en', 'NEW ' || text FROM docs WHERE lang NOT IN ('en', 'fr')""",
    DOCS,
)
_oracle(
    "text_for_language",
    f"""SELECT id_, CASE WHEN lang <> 'en' THEN reverse(text) ELSE {_clean("text")} END AS text_en,
               text AS text_any FROM docs""",
    DOCS,
)

# classification ---------------------------------------------------------------------------------

_oracle(
    "classify_sentiment",
    """SELECT id_, CAST(ix AS BIGINT) AS ix,
              CASE WHEN (p >= n) = (ix = 0) THEN 'POSITIVE' ELSE 'NEGATIVE' END AS topic,
              round(CASE WHEN ix = 0 THEN share ELSE 1 - share END, 6) AS score, 'model' AS agent
       FROM (SELECT *, CASE WHEN p + n = 0 THEN 0.5 ELSE greatest(p, n) / CAST(p + n AS DOUBLE) END AS share
             FROM (SELECT docs.id_, count(*) FILTER (sign > 0) AS p, count(*) FILTER (sign < 0) AS n
                   FROM docs LEFT JOIN (SELECT id_, sign FROM tokens JOIN polarity USING (word)) s ON s.id_ = docs.id_
                   GROUP BY docs.id_)) CROSS JOIN (VALUES (0), (1)) v(ix)""",
    DOCS, TOKENS, POLARITY,
)
_oracle(
    "classify_labels",
    "SELECT id_, CAST(ix AS BIGINT) AS ix, topic, round(score, 6) AS score, 'model' AS agent FROM scores",
    DOCS, TOKENS, TERMS, SCORES,
)
_oracle(
    "classify_centroid",
    """SELECT vec_id, l AS label, CASE WHEN round(dot / (sqrt(nv) * sqrt(nm)), 6) = 0 THEN CAST(0 AS DOUBLE)
              ELSE round(dot / (sqrt(nv) * sqrt(nm)), 6) END AS score FROM (
         SELECT vec_id, means.label AS l, sum(v * m) AS dot, sum(v * v) AS nv, sum(m * m) AS nm
         FROM dims JOIN means USING (d) GROUP BY ALL)""",
    """dims AS (SELECT vec_id, label, unnest(range(len(embedding))) AS d,
         CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)""",
    "means AS (SELECT label, d, avg(v) AS m FROM dims GROUP BY ALL)",
)
_oracle(
    "top_classification", "SELECT id_, topic, round(score, 6) AS score FROM best", DOCS, TOKENS, TERMS, SCORES
)
_oracle(
    "topic_vocabulary",
    """SELECT topic, count(*) AS messages FROM (
         SELECT id_, topic FROM scores WHERE score > 0
         UNION ALL SELECT id_, 'POSITIVE' FROM polar WHERE p > 0 OR n = 0
         UNION ALL SELECT id_, 'NEGATIVE' FROM polar WHERE n > 0 OR p = 0) GROUP BY topic""",
    DOCS, TOKENS, TERMS, POLARITY, SCORES,
    """polar AS (SELECT docs.id_, count(*) FILTER (sign > 0) AS p, count(*) FILTER (sign < 0) AS n
       FROM docs LEFT JOIN (SELECT id_, sign FROM tokens JOIN polarity USING (word)) s ON s.id_ = docs.id_
       GROUP BY docs.id_)""",
)

# places -------------------------------------------------------------------------------------------

NAMES = f"""names AS (
  SELECT 0 AS field_ix, CAST(loc_id AS BIGINT) AS loc_id, {_strip("lower(name)")} AS name, lon, lat FROM places WHERE {_strip("name")} <> ''
  UNION ALL SELECT 1, CAST(loc_id AS BIGINT), {_strip("lower(name_alt)")}, lon, lat FROM places WHERE {_strip("name_alt")} <> '')"""
INSIDE = """inside AS (
  SELECT id_, region_id, name, lon, lat FROM ev JOIN edges ON (y1 > lat) <> (y2 > lat)
    AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
  GROUP BY ALL HAVING count(*) % 2 = 1)"""
_oracle(
    "geo_text_match",
    """SELECT id_, field_ix, loc_id, name, round(CAST(lon AS DOUBLE), 6) AS lon, round(CAST(lat AS DOUBLE), 6) AS lat
       FROM docs JOIN names ON contains(lower(docs.text), names.name)""",
    DOCS, PLACES, NAMES,
)
ORACLES["geo_text_match_blocked"] = ORACLES["geo_text_match"]
_oracle(
    "geo_point_in_region",
    """SELECT id_, 0 AS field_ix, CAST(region_id AS BIGINT) AS loc_id, name, round(lon, 6) AS lon, round(lat, 6) AS lat FROM inside""",
    EVENTS, EDGES, INSIDE,
)
ORACLES["geo_point_in_region_grid"] = ORACLES["geo_point_in_region"]
_oracle(
    "region_centroids",
    """SELECT region_id, round(sum((x1 + x2) * w) / (3 * sum(w)), 6) AS lon,
              round(sum((y1 + y2) * w) / (3 * sum(w)), 6) AS lat,
              round(min(y1), 6) AS low, round(max(y1), 6) AS high
       FROM (SELECT *, x1 * y2 - x2 * y1 AS w FROM (
         SELECT region_id, unnest(xs) AS x1, unnest(ys) AS y1,
                unnest(list_concat(xs[2:], xs[:1])) AS x2, unnest(list_concat(ys[2:], ys[:1])) AS y2
         FROM (SELECT region_id, [lon - 1, lon + 1, lon + 1, lon, lon - 1] AS xs,
                      [low, low, high, high + 1, high] AS ys FROM spans)))
       GROUP BY region_id""",
    EVENTS,
    "spans AS (SELECT user_id AS region_id, lon, min(lat) AS low, max(lat) AS high FROM ev GROUP BY ALL)",
)
_oracle(
    "scan_gazetteer",
    f"SELECT 'user ' || region_id AS name, lon, lat, CAST(5 AS BIGINT) AS points FROM ({ORACLES['region_centroids']})",
)
_oracle(
    "geolocate",
    """SELECT source, id_, row_number() OVER (PARTITION BY source, id_ ORDER BY field_ix, loc_id) - 1 AS ix,
              name, round(lon, 6) AS lon, round(lat, 6) AS lat
       FROM (SELECT 'documents' AS source, id_, field_ix, loc_id, name, lon, lat
             FROM (SELECT docs.id_, names.* FROM docs JOIN names ON contains(lower(docs.text), names.name))
             UNION ALL SELECT 'events', id_, 0, region_id, name, lon, lat FROM inside)""",
    DOCS, EVENTS, PLACES, NAMES, EDGES, INSIDE,
)

# anonymisation --------------------------------------------------------------------------------------

_oracle("anonymize_text", f"SELECT source, id_, {_redact('text')} AS text FROM both_", DOCS, PAGE_BODIES, _BOTH)
_oracle(
    "anonymize_counts",
    """SELECT kind, CAST(sum(n) AS BIGINT) AS matches, count(*) FILTER (n > 0) AS messages FROM (
         SELECT kind, len(regexp_extract_all(text, '\\[' || kind || '\\]')) AS n
         FROM (SELECT *, unnest(kinds) AS kind FROM redacted))
       GROUP BY kind""".replace("kinds", "[" + ", ".join(_q(k) for k in KINDS) + "]"),
    DOCS,
    f"redacted AS (SELECT id_, {_redact('text')} AS text FROM docs)",
)
_oracle(
    "anonymize_translation",
    f"""SELECT id_, CASE WHEN lang = 'en' THEN {_redact("text")} ELSE text END AS text,
               CASE WHEN lang = 'en' THEN '' ELSE {_redact("new_text")} END AS translated FROM translated""",
    DOCS, *LANGUAGE, TRANSLATED,
)

# chain and review --------------------------------------------------------------------------------------

_oracle(
    "enrich_pipeline",
    f"""SELECT id_, {_redact("text")} AS text, new_text AS translated, from_lang, topic,
               CAST(3 AS BIGINT) AS classifications, coalesce(n, 0) AS locations
        FROM translated JOIN best USING (id_) LEFT JOIN (
          SELECT id_, count(*) AS n FROM docs JOIN names ON contains(lower(docs.text), names.name) GROUP BY id_)
          USING (id_)
        WHERE length(text) >= 20""",
    DOCS, *LANGUAGE, TRANSLATED, TERMS, SCORES, PLACES, NAMES,
)
_oracle(
    "stage_totals",
    """SELECT CAST(ix AS BIGINT) AS ix, stage, CASE ix WHEN 0 THEN n ELSE k END AS messages
       FROM (VALUES (0, 'extract'), (1, 'filter'), (2, 'translate'), (3, 'classify'), (4, 'anonymize'), (5, 'processed'))
            AS stages(ix, stage),
            (SELECT count(*) AS n, count(*) FILTER (WHERE length(text) >= 20) AS k FROM documents)""",
)
RECORDS = f"""uniq AS (
  SELECT *, lower(country) AS workspace, country || '-2024-01-01-2024-02-01' AS dataset FROM translated
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY datetime_, num) = 1),
records AS (
  SELECT workspace, dataset, id_ AS external_id, text AS text_original, new_text AS text_translated, topic,
         round(score, 6) AS score, channel, members AS group_members, source, number,
         CASE WHEN {_WITH_KEYWORD} THEN 'Yes' ELSE 'No' END AS keyword_flag,
         from_lang AS translation_from_lang, 'en' AS translation_to_lang,
         strftime(datetime_, '%Y-%m-%dT%H:%M:%S') AS datetime, country, datetime_
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY datetime_, num) AS number FROM uniq)
  JOIN best USING (id_)
  JOIN (SELECT source AS channel, count(*) AS members FROM documents GROUP BY 1) USING (channel)
  WHERE text <> '')"""
ANSWERS = f"""answers AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS external_id,
         CASE WHEN quality = 1 THEN 'submitted' ELSE 'discarded' END AS status,
         CASE WHEN quality = 1 THEN
           CASE WHEN toxic = 1 THEN [CASE WHEN n_chars > 400 THEN 'water' ELSE 'shelter' END, 'health']
                ELSE [CASE WHEN n_chars > 400 THEN 'water' ELSE 'shelter' END] END END AS topics,
         CASE WHEN toxic = 1 THEN '[redacted]' END AS anonymization,
         CASE WHEN n_chars > 2000 THEN 'revised' END AS translation
  FROM labels l JOIN documents d USING (doc_id))"""
_REVIEW = (DOCS, *LANGUAGE, TRANSLATED, TERMS, SCORES, RECORDS)
_oracle("review_export", "SELECT * EXCLUDE (datetime_) FROM records", *_REVIEW)
_oracle("review_numbering", "SELECT workspace, dataset, external_id, number FROM records", *_REVIEW)
_oracle(
    "review_set_round_trip",
    "SELECT workspace, dataset, external_id, text_original, number FROM records WHERE workspace = 'gbr'",
    *_REVIEW,
)
_oracle(
    "metadata_decode",
    "SELECT external_id, number, keyword_flag, channel, group_members, datetime FROM records",
    *_REVIEW,
)
_oracle(
    "review_import",
    """SELECT external_id AS id_, datetime_, country, channel, text_original AS text, group_members,
              coalesce(translation, text_translated) AS translated, CAST(c.ix AS BIGINT) AS ix, c.topic, c.score, c.agent
       FROM (SELECT *, unnest(list_concat([{'ix': 0, 'topic': topic, 'score': CAST(score AS DOUBLE), 'agent': 'model'}],
               list_transform(coalesce(topics, []), lambda t, i: {'ix': CAST(i AS INTEGER), 'topic': t,
                 'score': CAST(1.0 AS DOUBLE), 'agent': 'human'}))) AS c
             FROM records LEFT JOIN answers USING (external_id))""",
    *_REVIEW, ANSWERS,
)
_oracle(
    "first_records",
    """SELECT workspace, dataset, external_id, number FROM records
       QUALIFY row_number() OVER (PARTITION BY workspace, dataset ORDER BY number) <= 5""",
    *_REVIEW,
)
_oracle(
    "review_only_submitted",
    """SELECT external_id AS id_, country, len(topics) AS human_labels
       FROM records JOIN answers USING (external_id) WHERE status = 'submitted'""",
    *_REVIEW, ANSWERS,
)
_oracle(
    "review_apply_anonymization",
    """SELECT workspace, external_id, coalesce(anonymization, text_original) AS text
       FROM records LEFT JOIN answers USING (external_id)""",
    *_REVIEW, ANSWERS,
)
_oracle(
    "review_agreement",
    """SELECT topic AS suggested, human, count(*) AS records, topic IS NOT DISTINCT FROM human AS agree
       FROM (SELECT topic, unnest(topics) AS human FROM records JOIN answers USING (external_id)
             WHERE status = 'submitted') GROUP BY ALL""",
    *_REVIEW, ANSWERS,
)

# streams ---------------------------------------------------------------------------------------------------

_oracle(
    "stream_ingest",
    """SELECT id_, datetime_, 'GBR' AS country, 'Telegram' AS source, channel, text FROM docs WHERE text <> ''""",
    DOCS,
)
_oracle("stream_dedupe", "SELECT id_, datetime_, country, channel, text FROM ev", EVENTS)
_oracle(
    "stream_upsert",
    f"""SELECT id_, datetime_, {SCRAPED} + INTERVAL 1 DAY AS datetime_scraped_, country, channel,
               'edited ' || text AS text FROM ev""",
    EVENTS, _SPLIT,
)
