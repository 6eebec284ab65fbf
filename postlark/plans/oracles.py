"""DuckDB SQL giving the result of each registered query, written independently of the operators.

Where an operator uses a shortcut the SQL takes the long way: the link pattern in its plain form,
the stemmer letter by letter, the classifier over a TF-IDF table, rhythm from the gaps themselves.
"""

from __future__ import annotations

from postlark.functions import stemming
from postlark.functions.contacts import EMAIL_PATTERN, PHONE_PATTERN
from postlark.functions.links import LINK_PATTERN
from postlark.functions.text import KEYWORDS
from postlark.plans.queries import (
    DAY_ELEVEN, PEOPLE_BATCH, RETENTION_NOW, SURROGATE_LIMITS, SURROGATE_SITES,
)

BLANK = r"[ \t\n\x0B\f\r]"
PUNCT = r"""[!-"$-/:-@\[-`{-~]"""
ALL_PUNCT = r"""[!-/:-@\[-`{-~]"""


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# -- posts ------------------------------------------------------------------------------------

POSTS = """posts AS (
  SELECT e.event_id AS id,
    d.text || ' #' || e.event_type || ' #K' || json_extract_string(e.props, '$.k')
      || CASE e.event_type WHEN 'purchase' THEN ' Hiring' WHEN 'click' THEN ' career' ELSE '' END
      || CASE WHEN e.event_id % 3 = 0 THEN '' ELSE ' http://t.co/' || CAST(e.event_id % 997 AS VARCHAR) END
      AS text,
    d.lang, e.ts AS created_at, epoch_us(e.ts) // 1000 AS created_ms, p.url AS source,
    CAST(floor(e.value) AS BIGINT) AS favorites,
    CASE WHEN e.event_id % 4 <> 0 THEN d.source END AS place,
    e.event_type = 'view' AS is_retweet,
    CASE WHEN e.event_type = 'view' THEN e.event_id - e.event_id % 10 END AS retweeted_id,
    e.user_id,
    'user' || e.user_id || CASE WHEN e.event_type = 'signup' THEN '_new' ELSE '' END AS screen_name,
    'User ' || e.user_id AS user_name, d.source AS location
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""

LINKED = f"""linked AS (
  SELECT *, nullif(regexp_extract(text, {_q(LINK_PATTERN)}, 0), '') AS link, md5(text) AS hash,
    regexp_extract_all(text, '(#\\w+)', 1) AS raw_tags,
    CASE WHEN is_retweet THEN retweeted_id ELSE id END AS tweet_id,
    ({" OR ".join(f"contains(lower(source), '{s}')" for s in SURROGATE_SITES)}) AS third_party
  FROM posts)"""

KEYED = """keyed AS (
  SELECT *, CASE WHEN link IS NOT NULL THEN 'L:' || link ELSE 'H:' || hash END AS repeat_key
  FROM linked)"""


def _first(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY repeat_key ORDER BY created_at, id) = 1)"""


TAG_LIST = "list_transform(raw_tags, lambda t: lower(replace(t, '#', '')))"

ROWS = f"""kept_rows AS (
  SELECT id AS post_id, CAST(user_id AS VARCHAR) AS person_id, screen_name AS person_name,
    CAST(tweet_id AS VARCHAR) AS tweet_id, text, created_ms, {TAG_LIST} AS tags,
    '[]' AS phone, '[]' AS email, coalesce(link, '') AS link, hash, third_party,
    CASE WHEN is_retweet THEN 'RETWEETED' ELSE 'TWEETED' END AS relation,
    md5(CAST(user_id AS VARCHAR) || chr(1) || screen_name) AS person_key
  FROM winners)"""
GRAPH = (POSTS, LINKED, KEYED, _first("keyed", "winners"), ROWS)

VERTICES = """vertices AS (
  SELECT DISTINCT tweet_id AS id, text, created_ms, array_to_string(tags, ',') AS tags, phone,
    email, link, hash, third_party,
    md5(concat_ws(chr(1), tweet_id, text, CAST(created_ms AS VARCHAR), array_to_string(tags, ','),
      phone, email, link, hash, CAST(third_party AS VARCHAR))) AS post_key
  FROM kept_rows)"""
PERSONS = """persons AS (
  SELECT DISTINCT person_id AS id, person_name AS name, person_key FROM kept_rows)"""
TAGS = "tags AS (SELECT DISTINCT unnest(tags) AS name FROM kept_rows)"
POSTED = """posted AS (
  SELECT person_key, tweet_id, relation, min(created_ms) AS first_ms, max(created_ms) AS last_ms
  FROM kept_rows GROUP BY ALL)"""
EXPLODED = """exploded AS (
  SELECT post_id, person_id, tweet_id, created_ms, unnest(tags) AS tag FROM kept_rows)"""
TAGGED = """tagged AS (
  SELECT tweet_id, tag, min(created_ms) AS first_ms, max(created_ms) AS last_ms
  FROM exploded GROUP BY ALL)"""

# -- tokens and stems -------------------------------------------------------------------------


def _cleaned(table: str, key: str = "doc_id") -> str:
    return f"""cleaned AS (
  SELECT {key}, regexp_replace(regexp_replace(text, 'http:\\/\\/[a-zA-Z\\/.0-9]*', '', 'g'),
    {_q(PUNCT)}, '', 'g') AS c FROM {table})"""


TOKENS = f"""trimmed AS (SELECT *, regexp_replace(c, {_q(BLANK + "+$")}, '') AS t FROM cleaned),
tokenized AS (
  SELECT doc_id, CASE WHEN t = '' AND c <> '' THEN CAST([] AS VARCHAR[])
    ELSE string_split_regex(t, {_q(BLANK)}) END AS toks FROM trimmed)"""


def _letters(word: str) -> str:
    """Vowels and consonants of a word, read from its end."""
    return (
        f"CASE WHEN {word} = '' THEN '' ELSE list_reduce(list_reverse(string_split({word}, '')), "
        "lambda acc, ch: CASE WHEN ch IN ('a','e','i','o','u') THEN 'v' "
        "WHEN ch = 'y' AND left(acc, 1) = 'c' THEN 'v' ELSE 'c' END || acc, '') END"
    )


def _cut(n: int, word: str = "s") -> str:
    return f"left({word}, length({word}) - {n})"


def _steps(word: str) -> str:
    """Number of vowel-consonant steps."""
    return f"len(regexp_extract_all({_letters(word)}, 'vc'))"


def _cvc(word: str) -> str:
    return f"({_letters(word)} LIKE '%cvc' AND {word}[-2] NOT IN ('w', 'x', 'y'))"


def _rules(rules: list[tuple[str, str, str]]) -> str:
    cases = " ".join(
        f"WHEN ends_with(s, '{suffix}') AND {condition.format(r=_cut(len(suffix)))} "
        f"THEN {_cut(len(suffix))} || '{new}'"
        for suffix, new, condition in rules
    )
    return f"CASE {cases} ELSE s END"


class _Condition(str):
    """Condition on the rest of the word, filled in per suffix."""

    def format(self, r: str) -> str:  # type: ignore[override]
        return self.replace("@r", r)


def _on_rest(template) -> _Condition:
    return _Condition(template("@r"))


_ANY = _on_rest(lambda r: "true")
_VOWEL = _on_rest(lambda r: f"({_letters(r)}) LIKE '%v%'")
_M0 = _on_rest(lambda r: f"{_steps(r)} > 0")
_M1 = _on_rest(lambda r: f"{_steps(r)} > 1")
_ION = _on_rest(lambda r: f"({r}[-1] IN ('s', 't') AND {_steps(r)} > 1)")
_E = _on_rest(lambda r: f"({_steps(r)} > 1 OR ({_steps(r)} = 1 AND NOT {_cvc(r)}))")

_REPAIR = " ".join(f"WHEN ends_with(b, '{s}') THEN b || 'e'" for s, _ in stemming.AFTER_PARTICIPLE)

STEMS = f"""vocabulary AS (SELECT DISTINCT unnest(toks) AS w FROM tokenized),
s0 AS (SELECT w, lower(w) AS s FROM vocabulary),
s1 AS (SELECT w, {_rules([(s, r, _ANY) for s, r in stemming.PLURALS])} AS s FROM s0),
s2 AS (SELECT w, s, CASE
  WHEN ends_with(s, 'ed') AND {_VOWEL.format(_cut(2))} THEN {_cut(2)}
  WHEN ends_with(s, 'ing') AND {_VOWEL.format(_cut(3))} THEN {_cut(3)} END AS b FROM s1),
s3 AS (SELECT w, CASE
  WHEN b IS NULL THEN {_rules([("eed", "ee", _M0)])}
  {_REPAIR}
  WHEN length(b) > 1 AND b[-1] = b[-2] AND b[-1] NOT IN ('a','e','i','o','u','l','s','z') THEN {_cut(1, "b")}
  WHEN {_steps("b")} = 1 AND {_cvc("b")} THEN b || 'e'
  ELSE b END AS s FROM s2),
s4 AS (SELECT w, {_rules([("y", "i", _VOWEL)])} AS s FROM s3),
s5 AS (SELECT w, {_rules([(s, r, _M0) for s, r in stemming.DOUBLE_SUFFIXES])} AS s FROM s4),
s6 AS (SELECT w, {_rules([(s, r, _M0) for s, r in stemming.SINGLE_SUFFIXES])} AS s FROM s5),
s7 AS (SELECT w, {_rules([(s, "", _ION if s == "ion" else _M1) for s in stemming.ENDINGS])} AS s FROM s6),
s8 AS (SELECT w, {_rules([("e", "", _E)])} AS s FROM s7),
stems AS (SELECT w, CASE WHEN ends_with(s, 'll') AND {_steps("s")} > 1 THEN {_cut(1)} ELSE s END AS stem
  FROM s8)"""

TERMS = """terms AS (
  SELECT doc_id, stem AS term, count(*) AS tf
  FROM (SELECT doc_id, unnest(toks) AS w FROM tokenized) JOIN stems USING (w) GROUP BY ALL)"""
ALL_TERMS = (_cleaned("documents"), TOKENS, STEMS, TERMS)
WEIGHTS = """weights AS (
  SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf
  FROM terms GROUP BY term)"""

TRAINING = "(('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8))::BIGINT % 1000 < 700)"
# Model over the labelled documents; predictions need the terms of all documents, so all are stemmed.
MODEL = f"""corpus AS (SELECT doc_id, CAST(quality AS DOUBLE) AS label, {TRAINING} AS training
  FROM documents JOIN labels USING (doc_id)),
weights AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM corpus) + 1) / (count(*) + 1)) AS idf
  FROM terms JOIN corpus USING (doc_id) GROUP BY term),
trained AS (SELECT label, term, sum(tf * idf) AS s FROM terms JOIN corpus USING (doc_id)
  JOIN weights USING (term) WHERE training GROUP BY ALL),
priors AS (SELECT label, count(*) AS n_docs,
  ln(count(*) + 0.0001) - ln((SELECT count(*) FROM corpus WHERE training) + 0.0001 * 2) AS log_prior
  FROM corpus WHERE training GROUP BY label),
sums AS (SELECT label, sum(s) AS total FROM trained GROUP BY label),
bases AS (SELECT label, ln(total + 0.0001 * (SELECT count(*) FROM weights)) AS base FROM sums),
likelihoods AS (SELECT b.label, w.term, ln(coalesce(t.s, 0) + 0.0001) - b.base AS log_likelihood
  FROM weights w CROSS JOIN bases b LEFT JOIN trained t ON t.term = w.term AND t.label = b.label),
scored AS (SELECT t.doc_id, b.label, sum(t.tf * coalesce(w.idf, ln((SELECT count(*) FROM corpus) + 1))
    * coalesce(l.log_likelihood, ln(0.0001) - b.base)) AS score
  FROM terms t CROSS JOIN bases b LEFT JOIN weights w ON w.term = t.term
  LEFT JOIN likelihoods l ON l.term = t.term AND l.label = b.label GROUP BY ALL),
predicted AS (SELECT d.doc_id, p.label AS prediction
  FROM documents d CROSS JOIN priors p LEFT JOIN scored s ON s.doc_id = d.doc_id AND s.label = p.label
  QUALIFY row_number() OVER (PARTITION BY d.doc_id
    ORDER BY coalesce(s.score, 0) + p.log_prior DESC, p.label) = 1)"""
CLASSIFIED = (*ALL_TERMS, MODEL)

# -- posting rhythm ---------------------------------------------------------------------------

TIMELINE = """timeline AS (
  SELECT user_id, event_id AS post_id, epoch_us(ts) // 1000 AS ms, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"""


def _gaps(size: int | None) -> str:
    keep = f"WHERE rn <= {size}" if size else ""
    return f"""gaps AS (
  SELECT user_id, post_id, rn, (lag(ms) OVER u - ms) // 1000 AS dt FROM timeline {keep}
  WINDOW u AS (PARTITION BY user_id ORDER BY rn)),
changes AS (SELECT *, lag(dt) OVER (PARTITION BY user_id ORDER BY rn) - dt AS dd FROM gaps),
means AS (SELECT user_id, coalesce(sum(dt), 0) // greatest(count(dt), 1) AS f,
    coalesce(sum(dd), 0) // greatest(count(dd), 1) AS r FROM changes GROUP BY user_id),
spreads AS (SELECT user_id, f, r, coalesce(sum((dt - f) * (dt - f)), 0) AS v
  FROM changes JOIN means USING (user_id) GROUP BY ALL)"""


def _scores(limits=(600, 60, 500_000_000), size: int | None = 20, wrap: bool = False) -> str:
    v = "(((v + 2147483648) % 4294967296) + 4294967296) % 4294967296 - 2147483648" if wrap else "v"
    return f"""{TIMELINE},
{_gaps(size)},
scores AS (SELECT user_id, CAST(f AS BIGINT) AS avg_tweet_freq, CAST(r AS BIGINT) AS avg_tweet_reg,
    CAST({v} AS BIGINT) AS tweet_freq_variance,
    (f < {limits[0]} OR (r < {limits[1]} AND r > -{limits[1]})) AND NOT ({v}) > {limits[2]} AS is_bot
  FROM spreads)"""


_SCALED = (SURROGATE_LIMITS.fast, SURROGATE_LIMITS.regular, SURROGATE_LIMITS.spread)
_ALL_SCORES = "SELECT * FROM scores"

_CONTACTS = """found AS (
  SELECT {key},
    list_sort(list_distinct(list_filter(string_split_regex(regexp_replace({text}, {punct}, '', 'g'), {gap}),
      lambda t: regexp_full_match(t, {phone})))) AS phones,
    list_sort(list_distinct(list_filter(string_split_regex({text}, {gap}),
      lambda t: regexp_full_match(t, {email})))) AS emails
  FROM {table})"""


def _contacts(table: str, key: str, text: str) -> str:
    return _CONTACTS.format(
        table=table, key=key, text=text, punct=_q(ALL_PUNCT), gap=_q(BLANK + "+"),
        phone=_q(PHONE_PATTERN), email=_q(EMAIL_PATTERN),
    )


_TEXT_KEYWORD = "(" + " OR ".join(f"contains(lower(text), '{k}')" for k in KEYWORDS) + ")"

_STORED = f"""stored_posts AS (SELECT * FROM keyed WHERE created_at < TIMESTAMP '{DAY_ELEVEN}'),
arriving AS (SELECT * FROM keyed WHERE created_at >= TIMESTAMP '{DAY_ELEVEN}'),
{_first("arriving", "arrived")},
fresh AS (SELECT * FROM arrived WHERE repeat_key NOT IN (SELECT repeat_key FROM stored_posts))"""

_WANTED = f"""wanted AS (
  SELECT *, {_TEXT_KEYWORD} AS matched FROM keyed WHERE lang = 'en'
    AND length(text) + length(regexp_replace(text, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) > 80)"""
_TEXTS = """texts AS (
  SELECT 'd' || doc_id AS doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL SELECT DISTINCT md5(text), text FROM wanted WHERE matched)"""
# The model as above, over the labelled documents and the posts that have a keyword.
_POST_MODEL = MODEL.replace("SELECT doc_id, CAST(quality", "SELECT 'd' || documents.doc_id AS doc_id, CAST(quality").replace(
    TRAINING, TRAINING.replace("doc_id", "documents.doc_id")).replace("FROM documents d", "FROM texts d").replace(
    "FROM documents JOIN labels USING (doc_id)", "FROM documents JOIN labels ON labels.doc_id = documents.doc_id")
_POST_SCORES = f"""post_scores AS (
  SELECT w.*, CASE WHEN matched THEN p.prediction ELSE 0.0::DOUBLE END AS prediction
  FROM wanted w LEFT JOIN predicted p ON p.doc_id = w.hash)"""
SCORED_POSTS = (POSTS, LINKED, KEYED, _WANTED, _TEXTS, _cleaned("texts"), TOKENS, STEMS, TERMS, _POST_MODEL, _POST_SCORES)
_ACCEPTED = "accepted AS (SELECT * FROM post_scores WHERE prediction = 1 AND favorites % 7 NOT IN (0, 1, 2))"
STORED_POSTS = (*SCORED_POSTS, _ACCEPTED, _first("accepted", "winners"))
_BATCH = "CASE WHEN created_at < TIMESTAMP '2024-01-11' THEN 0 WHEN created_at < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END"

ORACLES: dict[str, str] = {
    "bot_cadence": _with(_scores(), select=_ALL_SCORES),
    "bot_cadence_scaled": _with(_scores(_SCALED), select=_ALL_SCORES),
    "bot_cadence_int32": _with(_scores(wrap=True), select=_ALL_SCORES),
    "bot_cadence_full_history": _with(_scores(_SCALED, size=None), select=_ALL_SCORES),
    "newest_posts": _with(TIMELINE, select="SELECT user_id, post_id FROM timeline WHERE rn <= 20"),
    "gap_changes": _with(TIMELINE, _gaps(20), select="SELECT user_id, post_id, dt, dd FROM changes"),
    "bot_unscored_batch": f"""SELECT DISTINCT user_id FROM events
WHERE user_id NOT IN (SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT {PEOPLE_BATCH})
ORDER BY user_id LIMIT 150""",
    "bot_writeback": _with(
        POSTS, _scores(),
        select="""SELECT id AS post_id, user_id, avg_tweet_freq, avg_tweet_reg, tweet_freq_variance, is_bot
FROM posts LEFT JOIN scores USING (user_id)""",
    ),
    "graph_scored_persons": _with(
        *GRAPH, PERSONS, _scores(),
        select="""SELECT id, name, person_key, avg_tweet_freq, avg_tweet_reg, tweet_freq_variance, is_bot
FROM persons LEFT JOIN scores ON CAST(user_id AS VARCHAR) = id""",
    ),
    "lang_length_filter": """SELECT doc_id, units FROM (
  SELECT doc_id, lang, CAST(length(text)
    + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS BIGINT) AS units FROM documents)
WHERE lang = 'en' AND units > 80""",
    "keyword_flag": _with(
        POSTS,
        select=f"""SELECT id, matched, CASE WHEN matched THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score,
  CASE WHEN matched THEN id END AS kept_id FROM (SELECT id, {_TEXT_KEYWORD} AS matched FROM posts)""",
    ),
    "post_texts": _with(POSTS, select="SELECT text FROM posts"),
    "clean_text": _with(_cleaned("documents"), select="SELECT doc_id, c AS cleaned FROM cleaned"),
    "tokens": _with(
        _cleaned("documents"), TOKENS,
        select="""SELECT doc_id, CAST(len(toks) AS BIGINT) AS n, array_to_string(toks, '|') AS tokens
FROM tokenized""",
    ),
    "stem_tokens": _with(
        _cleaned("documents"), TOKENS, STEMS,
        select="""SELECT doc_id, string_agg(stem, '|' ORDER BY place) AS stems FROM (
  SELECT doc_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS place FROM tokenized)
JOIN stems USING (w) GROUP BY doc_id""",
    ),
    "stem_vocabulary": _with(
        _cleaned("documents"), TOKENS, STEMS, select="SELECT w AS word, stem FROM stems"
    ),
    "link_list": _with(
        POSTS,
        f"""found AS (SELECT kind, id, regexp_extract_all(text, {_q(LINK_PATTERN)}, 0) AS links FROM (
  SELECT 'page' AS kind, page_id AS id, html AS text FROM pages
  UNION ALL SELECT 'post', id, text FROM posts))""",
        select="""SELECT kind, id, CAST(generate_subscripts(links, 1) - 1 AS BIGINT) AS place,
  unnest(links) AS link FROM found""",
    ),
    "first_link": _with(POSTS, LINKED, select="SELECT id, link FROM linked"),
    "hashtags": _with(
        POSTS, LINKED, select=f"SELECT id, array_to_string({TAG_LIST}, '|') AS tags FROM linked"
    ),
    "list_text": _with(
        POSTS, LINKED,
        select=f"SELECT id, '[' || array_to_string({TAG_LIST}, ',') || ']' AS tags FROM linked",
    ),
    "contacts_documents": _with(
        _contacts("documents", "doc_id", "text"),
        select="""SELECT doc_id, array_to_string(phones, ',') AS phone, array_to_string(emails, ',') AS email
FROM found""",
    ),
    "contacts_pages": _with(
        _contacts("pages", "page_id", "html"),
        select="""SELECT page_id, array_to_string(phones, ',') AS phone, array_to_string(emails, ',') AS email
FROM found""",
    ),
    "kv_parse": _with(
        POSTS,
        select="""SELECT id,
  CASE WHEN place IS NOT NULL THEN CAST(user_id AS VARCHAR) END AS p_id,
  CASE WHEN place IS NOT NULL THEN user_name || ', ' || location END AS p_name,
  CASE WHEN place IS NOT NULL THEN screen_name END AS p_screenname,
  CASE WHEN place IS NOT NULL THEN string_split(source, '=')[1] END AS p_url,
  CASE WHEN place IS NOT NULL THEN '' END AS p_location FROM posts""",
    ),
    "word_count": """SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN t = '' AND text <> '' THEN CAST([] AS VARCHAR[]) ELSE string_split(t, ' ') END) AS word
  FROM (SELECT text, rtrim(text, ' ') AS t FROM documents)) GROUP BY word""",
    "term_freq": _with(*ALL_TERMS, select="SELECT doc_id, term, tf FROM terms"),
    "idf": _with(*ALL_TERMS, WEIGHTS, select="SELECT term, df, round(idf, 6) AS idf FROM weights"),
    "tfidf": _with(
        *ALL_TERMS, WEIGHTS,
        select="SELECT doc_id, term, tf, round(tf * idf, 6) AS tfidf FROM terms JOIN weights USING (term)",
    ),
    "holdout_split": f"SELECT doc_id, {TRAINING} AS training FROM labels",
    "nb_priors": _with(*CLASSIFIED, select="SELECT label, n_docs, round(log_prior, 6) AS log_prior FROM priors"),
    "nb_likelihoods": _with(
        *CLASSIFIED,
        select="SELECT label, term, round(log_likelihood, 6) AS log_likelihood FROM likelihoods",
    ),
    "nb_predict": _with(*CLASSIFIED, select="SELECT doc_id, prediction FROM predicted"),
    "nb_accuracy": _with(
        *CLASSIFIED,
        select="""SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) AS n FROM predicted JOIN corpus USING (doc_id) WHERE NOT training""",
    ),
    "dedup_posts": _with(
        POSTS, LINKED, KEYED, _first("keyed", "winners"), select="SELECT id, repeat_key FROM winners"
    ),
    "dedup_vs_store": _with(POSTS, LINKED, KEYED, _STORED, select="SELECT id, repeat_key FROM fresh"),
    "insert_status": _with(
        POSTS, LINKED, KEYED.replace("AS (", "AS MATERIALIZED (", 1),
        f"stored_keys AS (SELECT DISTINCT repeat_key FROM keyed WHERE created_at < TIMESTAMP '{DAY_ELEVEN}')",
        f"""arriving AS (SELECT *, row_number() OVER (PARTITION BY repeat_key ORDER BY created_at, id) AS arrival
  FROM keyed WHERE created_at >= TIMESTAMP '{DAY_ELEVEN}')""",
        select="""SELECT id, CASE WHEN arrival = 1 AND s.repeat_key IS NULL THEN 'inserted' ELSE 'duplicate' END AS status
FROM arriving a LEFT JOIN stored_keys s ON s.repeat_key = a.repeat_key""",
    ),
    "aggregator_flag": _with(POSTS, LINKED, select="SELECT id, third_party FROM linked"),
    "aggregator_flag_table": _with(
        POSTS,
        """flagged AS (SELECT source, bool_or(contains(lower(source), site)) AS third_party
  FROM (SELECT DISTINCT source FROM posts) CROSS JOIN (SELECT lang || '/' || doc_id AS site FROM documents) GROUP BY source)""",
        select="SELECT id, third_party FROM posts JOIN flagged USING (source)",
    ),
    "post_document": _with(
        POSTS, LINKED,
        select="""SELECT id AS post_id, source, CAST(tweet_id AS VARCHAR) AS tweet_id, text,
  CAST(favorites AS VARCHAR) AS favorites, coalesce(place, '') AS place, user_id,
  screen_name AS user_name, '[]' AS phone, '[]' AS email, coalesce(link, '') AS link, hash, created_ms,
  third_party FROM linked""",
    ),
    "page_enrichment": _with(
        POSTS, _contacts("pages", "url", "html"),
        select="""SELECT id, '[' || array_to_string(phones, ',') || ']' AS phone,
  '[' || array_to_string(emails, ',') || ']' AS email FROM posts LEFT JOIN found ON url = source""",
    ),
    "retention": f"""SELECT event_id AS id FROM events
WHERE ts IS NULL OR ts >= TIMESTAMP '{RETENTION_NOW}' - INTERVAL 30 DAY""",
    "graph_persons": _with(*GRAPH, PERSONS, select="SELECT * FROM persons"),
    "graph_tweets": _with(*GRAPH, VERTICES, select="SELECT * FROM vertices"),
    "graph_tags": _with(*GRAPH, TAGS, select="SELECT * FROM tags"),
    "graph_posted": _with(*GRAPH, POSTED, select="SELECT * FROM posted"),
    "graph_tagged": _with(*GRAPH, EXPLODED, TAGGED, select="SELECT * FROM tagged"),
    "graph_posted_vertices": _with(
        *GRAPH, VERTICES,
        select="""SELECT DISTINCT r.person_key, v.post_key, r.relation
FROM kept_rows r JOIN vertices v ON v.id = r.tweet_id AND v.created_ms <= r.created_ms""",
    ),
    "graph_tagged_vertices": _with(
        *GRAPH, VERTICES, EXPLODED,
        select="""SELECT DISTINCT v.post_key, r.tag
FROM exploded r JOIN vertices v ON v.id = r.tweet_id AND v.created_ms <= r.created_ms""",
    ),
    "graph_names": _with(
        *GRAPH, VERTICES, PERSONS, TAGS,
        select="""SELECT 'PERSON' AS kind, name FROM persons UNION ALL SELECT 'TWEET', NULL FROM vertices
UNION ALL SELECT 'TAG', name FROM tags""",
    ),
    "edge_all_ok": _with(
        *GRAPH, EXPLODED,
        f"""late AS (SELECT DISTINCT tweet_id, tag FROM exploded
  WHERE created_ms >= epoch_ms(TIMESTAMP '{DAY_ELEVEN}'))""",
        select="""SELECT post_id, coalesce(bool_and(l.tag IS NOT NULL), true) AS all_ok
FROM kept_rows LEFT JOIN exploded e USING (post_id) LEFT JOIN late l ON l.tweet_id = e.tweet_id AND l.tag = e.tag
GROUP BY post_id""",
    ),
    "recommend": _with(
        *GRAPH, EXPLODED,
        "once AS (SELECT DISTINCT person_id, post_id, created_ms, tag FROM exploded)",
        """candidates AS (SELECT i.person_id, l.post_id, l.created_ms, count(*) AS shared
  FROM (SELECT DISTINCT person_id, tag FROM once) i JOIN once l USING (tag)
  WHERE l.person_id <> i.person_id GROUP BY ALL)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY person_id
  ORDER BY shared DESC, created_ms DESC, post_id DESC) AS rank FROM candidates)""",
        select="SELECT person_id, rank, post_id, shared FROM ranked WHERE rank <= 5",
    ),
    "envelope_roundtrip": _with(
        POSTS,
        select="""SELECT id AS message, favorites % 7 > 2 AS ok,
  CASE WHEN favorites % 7 > 2 THEN md5(text) END AS text_md5,
  CASE WHEN favorites % 7 > 2 THEN created_ms END AS created_ms,
  CASE WHEN favorites % 7 > 2 THEN screen_name END AS user_name,
  CASE WHEN favorites % 7 > 2 THEN retweeted_id END AS retweeted_id FROM posts""",
    ),
    "corpus_roundtrip": """SELECT doc_id AS id, source || ' ' || lang AS username,
  doc_id * 3600000 AS created_ms, '| ' || lang || ' |' AS location, replace(text, chr(10), ' ') AS text,
  CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM documents""",
    "search_flatten": """SELECT role AS username, conv_id * 100000 + turn AS id,
  strftime(make_timestamp(turn * 1000000), '%a %b %d %H:%M:%S +0000 %Y') AS created_at, '' AS location, text
FROM conversations""",
    "stream_dedup": _with(POSTS, LINKED, KEYED, select="SELECT DISTINCT repeat_key FROM keyed"),
    "stream_word_count_batches": """SELECT batch_id, word, count(*) AS n FROM (
  SELECT CAST(floor(doc_id * 3 / (SELECT count(*) FROM documents)) AS BIGINT) AS batch_id, unnest(string_split(text, ' ')) AS word
  FROM documents) GROUP BY ALL""",
    "stream_score": _with(*SCORED_POSTS, select="SELECT id, matched, prediction FROM post_scores"),
    "stream_store": _with(
        *STORED_POSTS,
        select="""SELECT id AS post_id, CAST(tweet_id AS VARCHAR) AS tweet_id, coalesce(link, '') AS link, hash, third_party
FROM winners""",
    ),
    "stream_store_counts": _with(
        *STORED_POSTS,
        select=f"""SELECT batch_id, CAST(messages AS BIGINT) AS messages, CAST(rejected AS BIGINT) AS rejected, coalesce(stored, 0) AS stored
FROM (SELECT CAST({_BATCH} AS BIGINT) AS batch_id, count(*) FILTER (favorites % 7 <> 2) AS messages,
    count(*) FILTER (favorites % 7 IN (0, 1)) AS rejected FROM posts GROUP BY ALL)
LEFT JOIN (SELECT CAST({_BATCH} AS BIGINT) AS batch_id, count(*) AS stored FROM winners GROUP BY ALL) USING (batch_id)""",
    ),
    "stream_store_by_state": _with(
        *STORED_POSTS, ROWS, EXPLODED, TAGGED, select="SELECT tweet_id, tag FROM tagged"
    ),
    "store_upkeep": _with(
        POSTS, LINKED, KEYED, _first("keyed", "winners"),
        select=f"""SELECT id AS post_id, hash, {_BATCH} < 2 AS merged FROM winners
WHERE created_at >= TIMESTAMP '{RETENTION_NOW}' - INTERVAL 30 DAY""",
    ),
    "store_bot_check": _with(
        POSTS, LINKED, KEYED, _first("keyed", "winners"), _scores(),
        select="""SELECT id AS post_id, avg_tweet_freq, avg_tweet_reg, tweet_freq_variance, is_bot
FROM winners LEFT JOIN scores USING (user_id)""",
    ),
}
ORACLES["stream_word_count"] = ORACLES["word_count"]
