"""Independent SQL of the core queries, for DuckDB over the same tables."""

from __future__ import annotations

_WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_NARROW = "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")


def _nfkc(x: str) -> str:
    """As far as the test tables need it: wide forms and the ellipsis."""
    return f"replace(translate({x}, '{_WIDE}', '{_NARROW}'), chr(8230), '...')"


def _norm(x: str) -> str:
    return rf"nullif(trim(regexp_replace(regexp_replace({_nfkc(x)}, '[\x00-\x1F\x7F-\x{{9F}}]', ' ', 'g'), '{_WS}+', ' ', 'g')), '')"


def _trim(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _tok(x: str) -> str:
    return f"CASE WHEN coalesce({_trim(x)}, '') = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({_trim(x)}, '{_WS}+') END"


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


#: Fixed values, as in the functions: patterns and words.
_BOILER = "cookie(s)? policy|accept( all)? cookies|privacy policy|terms of service|all rights reserved|sign up for our newsletter|subscribe to our newsletter|contact us"


def _boiler(x: str) -> str:
    return _trim(rf"array_to_string(list_filter(regexp_split_to_array({x}, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]'), lambda l: NOT regexp_matches(lower(l), '{_BOILER}')), chr(10))")


def _repeats(src: str, key: str, text: str) -> str:
    """Runs of one character, by islands of equal neighbours."""
    return f"""
  SELECT {key}, {text} AS t, string_agg(repeat(c, least(run, CASE WHEN c IN ('!', '?', '.', ',') THEN 2 WHEN c = chr(10) THEN run ELSE 3 END)), '' ORDER BY island) AS out
  FROM (
    SELECT {key}, {text}, c, i - rn AS g, min(i) AS island, count(*)::INT AS run
    FROM (SELECT {key}, {text}, c, i, row_number() OVER (PARTITION BY {key}, c ORDER BY i) AS rn
          FROM (SELECT {key}, {text}, unnest(string_split({text}, '')) AS c, generate_subscripts(string_split({text}, ''), 1) AS i FROM {src} WHERE {text} <> ''))
    GROUP BY {key}, {text}, c, i - rn
  ) GROUP BY {key}, {text}"""


#: Fixed values, as in the functions: stop words, patterns of personal data, votes of languages, toxic words.
_STOP = "the a an and or of to in for on at is it this that with as by from be are was were will would can could has have had about into over after before between up down".split()
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_PHONE = r"\b(?:\+?\d{1,3}[\s\-\.]?)?(?:\(?\d{2,4}\)?[\s\-\.]?)?\d{3,4}[\s\-\.]?\d{3,4}\b"
_CARD = r"\b(?:\d[ -]*?){13,16}\b"
_ROUGH = r"\+?\d[\d\- ]{7,}\d"
_IBAN = r"\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b"
_VOTES = {
    "en": "the of and to in is was that it for with as his he be at by had not are but from or have an they which their this were",
    "fr": "le la les des du et un une est dans que qui au aux pour sur pas ne se ce avec sont cette mais ou nous vous leur",
    "de": "der die das und ist nicht ein eine den dem des mit von zu auf für im sich auch als an es werden aus bei nach wie",
    "es": "el la los las de que y en un una es por con para del se su al lo como más pero sus le ya o este muy",
    "it": "il lo la gli le di che e un una è per con del della nel alla si non sono da come più anche ma questo molto dei",
    "nl": "de het een en van is dat niet in op te zijn voor met die aan ook als bij naar uit maar werd door nog om wordt over",
}
_BAD = {
    "profanity": "fuck fucking shit bitch bastard asshole crap damn dick piss",
    "insult": "idiot moron stupid loser dumb",
    "threat": "kill murder hurt shoot stab",
    "sexual_explicit": "sex porn nude naked",
    "identity_attack": "nigger nigga faggot retard",
}


def _n(x: str, p: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{p}')), 0)::BIGINT"


def _mask(x: str) -> str:
    for p, m in ((_EMAIL, "<EMAIL>"), (_PHONE, "<PHONE>"), (_CARD, "<CREDIT_CARD>"), (_IBAN, "<IBAN>")):
        x = f"regexp_replace({x}, '{p}', '{m}', 'g')"
    return x


def _canon(x: str) -> str:
    return f"regexp_replace({_trim(f'''lower(coalesce({x}, ''))''')}, '{_WS}+', ' ', 'g')"


_PRE = f"""
WITH n AS (SELECT *, {_norm('text')} AS text_norm FROM mainpipe_ingested_v1),
m AS (SELECT *, length(text_norm)::BIGINT AS char_len, CASE WHEN text_norm IS NULL THEN 0 ELSE len(string_split(text_norm, ' ')) END::BIGINT AS word_count FROM n),
pre AS (SELECT *, CASE
  WHEN text IS NULL THEN 'missing'
  WHEN text_norm IS NULL THEN 'empty_after_clean'
  WHEN lower(text_norm) IN ('nan', 'none', 'null', 'n/a', 'null value') THEN 'null_like'
  WHEN regexp_matches(text_norm, '^[\\d\\.\\-]+$') THEN 'numeric_like'
  WHEN char_len < 20 THEN 'too_short_chars'
  WHEN word_count < 2 THEN 'too_short_words'
  WHEN char_len > 100000 THEN 'too_long' END AS drop_reason FROM m)"""


def _tox(x: str, bad: dict[str, str] = _BAD) -> tuple[str, str, dict[str, str]]:
    every = _in(w for v in bad.values() for w in v.split())
    tok = rf"regexp_extract_all(lower(coalesce({x}, '')), '[\p{{L}}\p{{N}}_]+')"
    one = lambda ws: f"least(1.0::DOUBLE, len(list_filter(tk, lambda w: w IN ({ws})))::DOUBLE / greatest(len(tk), 1) * 5)"
    return tok, one(every), {k: one(_in(v.split())) for k, v in bad.items()}


_TOK, _TOX_ALL, _TOX = _tox("text_norm")
_, _OWN_ALL, _OWN = _tox("text_norm", {"profanity": "kettle lantern", "insult": "mayor tenant bürgermeister", "threat": "bridge puente", "sexual_explicit": "museum", "identity_attack": "the der"})
_QUALITY = (
    _PRE
    + f""",
f AS (SELECT *, string_split(text_norm, ' ') AS ws, {_TOK} AS tk FROM pre WHERE drop_reason IS NULL),
q AS (SELECT row_idx, url, char_len, len(ws)::BIGINT AS n_words, CASE
  WHEN len(ws) < 5 THEN 'too_short' WHEN len(ws) > 5000 THEN 'too_long'
  WHEN length(regexp_replace(text_norm, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(text_norm) < 0.5 THEN 'low_alpha_ratio'
  WHEN 1.0::DOUBLE - len(list_distinct(ws))::DOUBLE / len(ws) > 0.8 THEN 'high_repetition'
  WHEN regexp_matches(url, '/ads/|example-spam-site\\.com') THEN 'blocked_url'
  WHEN {_n('text_norm', _EMAIL)} + {_n('text_norm', r'\+?\d[\d\- ]{7,}\d')} > 20 THEN 'pii_heavy'
  WHEN {_TOX_ALL} >= 0.8 THEN 'high_toxicity' END AS drop_reason FROM f)"""
)
_LANG = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text_norm, '')), '\\p{{L}}+') AS tk,
  length(regexp_replace(text_norm, '[^\\p{{L}}]', '', 'g')) AS ls, length(regexp_replace(text_norm, '[^A-Za-z]', '', 'g')) AS asc_ls FROM mainpipe_cleaned_v2),
v AS (SELECT doc_id, ls, asc_ls, {', '.join(f"len(list_filter(tk, lambda w: w IN ({_in(ws.split())}))) AS {k}" for k, ws in _VOTES.items())} FROM t),
s AS (SELECT *, {' + '.join(_VOTES)} AS total, greatest({', '.join(_VOTES)}) AS best FROM v),
l AS (SELECT doc_id, ls, asc_ls, CASE WHEN total = 0 THEN 'unk' {' '.join(f"WHEN {k} = best THEN '{k}'" for k in _VOTES)} END AS lang_pred,
  CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE best::DOUBLE / total END AS lang_score FROM s),
r AS (SELECT *, CASE WHEN lang_pred = 'unk' THEN 'lang_unknown' WHEN lang_pred <> 'en' THEN 'non_english' WHEN lang_score < 0.8 THEN 'low_lang_confidence'
  WHEN ls > 0 AND (ls - asc_ls)::DOUBLE / ls > 0.5 THEN 'non_latin_heavy' END AS drop_reason FROM l)"""
_DEEP_TEXT = _PRE + f""",
h AS (SELECT row_idx, {_boiler("regexp_replace(text_norm, '<[^>]+>', ' ', 'g')")} AS b FROM pre WHERE text_norm IS NOT NULL),
rep AS ({_repeats('h', 'row_idx', 'b')}),
x AS (SELECT h.row_idx, coalesce(rep.out, h.b) AS text_deep_clean FROM h LEFT JOIN rep USING (row_idx)),
y AS (SELECT row_idx, text_deep_clean, {_tok('text_deep_clean')} AS tk FROM x),
deep AS (SELECT row_idx, len(tk)::BIGINT AS token_count, CASE WHEN len(tk) > 0 THEN len(list_distinct(tk))::DOUBLE / len(tk) ELSE 0 END AS u,
  CASE WHEN len(tk) > 0 THEN len(list_filter(tk, lambda w: lower(w) IN ({_in(_STOP)})))::DOUBLE / len(tk) ELSE 0 END AS stop,
  CASE WHEN len(tk) > 0 THEN list_max(map_values(list_histogram(tk)))::DOUBLE / len(tk) ELSE 0 END AS top FROM y),
dr AS (SELECT *, CASE WHEN token_count >= 3 AND top > 0.7 THEN 'repetitive_token_spam' WHEN token_count >= 10 AND u < 0.2 THEN 'low_unique_token_ratio'
  WHEN token_count >= 10 AND stop > 0.95 THEN 'high_stopword_ratio' END AS drop_reason FROM deep)"""


def _dedup(min_len: int, key: int) -> str:
    return f"""
WITH c AS (SELECT doc_id, {_canon('text_pii_masked')} AS canon FROM mainpipe_cleaned_v4),
k AS (SELECT doc_id, sha256(canon) AS exact_hash, substr(canon, 1, {key}) AS near_key, length(canon) >= {min_len} AND canon <> '' AS cand FROM c),
e AS (SELECT *, min(doc_id) OVER (PARTITION BY exact_hash) AS fe, min(doc_id) OVER (PARTITION BY near_key, cand) AS fn FROM k),
d AS (SELECT doc_id, exact_hash, near_key, doc_id <> fe AS is_dup_exact, cand AND doc_id <> fn AND doc_id = fe AS is_dup_near, fe, fn FROM e),
g AS (SELECT *, CASE WHEN is_dup_exact THEN fe WHEN is_dup_near THEN fn END AS dup_of,
  CASE WHEN is_dup_exact THEN 'exact_duplicate' WHEN is_dup_near THEN 'near_duplicate' END AS drop_reason FROM d)"""


_SCORED = """
WITH i AS (SELECT v4.doc_id, v2.url, v4.source, v2.text_norm, v4.text_deep_clean, v4.text_pii_masked, coalesce(least(1, greatest(0, v2.lang_score)), 0)::DOUBLE AS l, coalesce(v4.token_count, 0)::DOUBLE AS n,
  coalesce(least(1, greatest(0, v4.unique_token_ratio)), 0)::DOUBLE AS u, CASE WHEN coalesce(v4.has_pii, false) THEN 0 ELSE 1 END::DOUBLE AS p
  FROM mainpipe_cleaned_v4 AS v4 JOIN mainpipe_cleaned_v2 AS v2 USING (doc_id)),
s AS (SELECT *, least(1, greatest(0, 0.4::DOUBLE * l + 0.3::DOUBLE * (CASE WHEN n <= 0 THEN 0 WHEN n < 20 THEN n / 20
  WHEN n > 1000 THEN greatest(0, 1 - (least(n, 4000) - 1000) / 3000) ELSE 1 END)::DOUBLE + 0.2::DOUBLE * u + 0.1::DOUBLE * p))::DOUBLE AS q FROM i),
sc AS (SELECT *, round(q, 9) AS quality_score, CASE WHEN q >= 0.8 THEN 'high_quality' ELSE 'rest' END AS subset, 'web_sample' AS mixture_name FROM s)"""


def _describe(src: str, c: str) -> str:
    q = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return f"SELECT count({c})::BIGINT AS count, round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS std, round(min({c}::DOUBLE), 6) AS min, " + ", ".join(f"round(quantile_cont({c}::DOUBLE, {v}), 6) AS {k}" for k, v in q.items()) + f", round(max({c}::DOUBLE), 6) AS max FROM {src}"


def _summary(src: str, cols, mean: bool = True) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS metric, round(min({c}::DOUBLE), 6) AS min, round(max({c}::DOUBLE), 6) AS max, " + (f"round(avg({c}::DOUBLE), 6) AS mean, " if mean else "") + f"round(median({c}::DOUBLE), 6) AS median FROM {src}" for c in cols)


def _hist(src: str, c: str, n: int) -> str:
    return f"""
WITH e AS (SELECT min({c}::DOUBLE) AS lo, max({c}::DOUBLE) AS hi FROM {src}),
b AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least({n}, floor(({c}::DOUBLE - lo) / ((hi - lo) / {n})) + 1) END::BIGINT AS bin, lo, (hi - lo) / {n} AS w FROM {src}, e WHERE {c} IS NOT NULL)
SELECT bin, round(lo + (bin - 1) * w, 6) AS lower, round(lo + bin * w, 6) AS upper, count(*)::BIGINT AS count FROM b GROUP BY bin, lo, w"""


_FILLED = "coalesce(nullif(text_pii_masked, ''), nullif(text_deep_clean, ''), {})"
_SHARDS = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, coalesce(strlen(text), 0)::BIGINT AS n_tokens FROM documents"
_SPAM = f"WITH t AS (SELECT row_idx, {_tok('text')} AS tk FROM mainpipe_ingested_v1), u AS (SELECT row_idx, tk, CASE WHEN len(tk) > 0 THEN list_max(map_values(list_histogram(tk)))::DOUBLE / len(tk) ELSE 0.0::DOUBLE END AS top FROM t) "

_KIND = "CASE WHEN text IS NULL THEN 'VOID' WHEN regexp_matches(text, '^[1-9][0-9]{0,17}$') THEN 'BIGINT' ELSE 'STRING' END"
#: The whole run over the raw pages: cleaned, deepened and whole, with the reasons of each stage.
_RUN = _PRE + f""",
lv AS (SELECT row_idx, regexp_extract_all(lower(coalesce(text_norm, '')), '\\p{{L}}+') AS lt, length(regexp_replace(text_norm, '[^\\p{{L}}]', '', 'g')) AS ls, length(regexp_replace(text_norm, '[^A-Za-z]', '', 'g')) AS asc_ls FROM pre WHERE drop_reason IS NULL),
lw AS (SELECT row_idx, ls, asc_ls, {', '.join(f"len(list_filter(lt, lambda w: w IN ({_in(ws.split())}))) AS v_{k}" for k, ws in _VOTES.items())} FROM lv),
lx AS (SELECT *, {' + '.join('v_' + k for k in _VOTES)} AS total, greatest({', '.join('v_' + k for k in _VOTES)}) AS best FROM lw),
ly AS (SELECT *, CASE WHEN total = 0 THEN 'unk' {' '.join(f"WHEN v_{k} = best THEN '{k}'" for k in _VOTES)} END AS lang_pred, CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE best::DOUBLE / total END AS lang_score FROM lx),
lr AS (SELECT row_idx, CASE WHEN lang_pred = 'unk' THEN 'lang_unknown' WHEN lang_pred <> 'en' THEN 'non_english' WHEN lang_score < 0.8 THEN 'low_lang_confidence' WHEN ls > 0 AND (ls - asc_ls)::DOUBLE / ls > 0.5 THEN 'non_latin_heavy' END AS lang_reason FROM ly),
qf AS (SELECT *, string_split(text_norm, ' ') AS ws, {_TOK} AS tk FROM pre WHERE drop_reason IS NULL),
qr AS (SELECT row_idx, CASE WHEN len(ws) < 5 THEN 'too_short' WHEN len(ws) > 5000 THEN 'too_long' WHEN length(regexp_replace(text_norm, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(text_norm) < 0.5 THEN 'low_alpha_ratio'
  WHEN 1.0::DOUBLE - len(list_distinct(ws))::DOUBLE / len(ws) > 0.8 THEN 'high_repetition' WHEN regexp_matches(url, '/ads/|example-spam-site\\.com') THEN 'blocked_url'
  WHEN {_n('text_norm', _EMAIL)} + {_n('text_norm', _ROUGH)} > 20 THEN 'pii_heavy' WHEN {_TOX_ALL} >= 0.8 THEN 'high_toxicity' END AS quality_reason FROM qf),
cleaned AS (SELECT pre.row_idx, pre.doc_id, pre.text, pre.text_norm, pre.drop_reason AS early, coalesce(pre.drop_reason, lang_reason, quality_reason) AS reason FROM pre LEFT JOIN lr USING (row_idx) LEFT JOIN qr USING (row_idx)),
h AS (SELECT row_idx, {_boiler("regexp_replace(text_norm, '<[^>]+>', ' ', 'g')")} AS b FROM cleaned WHERE reason IS NULL),
rep AS ({_repeats('h', 'row_idx', 'b')}),
dx AS (SELECT h.row_idx, coalesce(rep.out, h.b) AS text_deep_clean FROM h LEFT JOIN rep USING (row_idx)),
dy AS (SELECT row_idx, text_deep_clean, {_tok('text_deep_clean')} AS tk FROM dx),
dz AS (SELECT row_idx, {_mask('text_deep_clean')} AS masked, CASE WHEN len(tk) >= 3 AND list_max(map_values(list_histogram(tk)))::DOUBLE / len(tk) > 0.7 THEN 'repetitive_token_spam'
  WHEN len(tk) >= 10 AND len(list_distinct(tk))::DOUBLE / len(tk) < 0.2 THEN 'low_unique_token_ratio' WHEN len(tk) >= 10 AND len(list_filter(tk, lambda w: lower(w) IN ({_in(_STOP)})))::DOUBLE / len(tk) > 0.95 THEN 'high_stopword_ratio' END AS deep_reason FROM dy),
deepened AS (SELECT cleaned.*, masked, deep_reason FROM cleaned LEFT JOIN dz USING (row_idx)),
uc AS (SELECT row_idx, {_canon('masked')} AS canon FROM deepened WHERE reason IS NULL AND deep_reason IS NULL),
ue AS (SELECT row_idx, min(row_idx) OVER (PARTITION BY canon) AS fe, length(canon) >= 200 AS cand, min(row_idx) OVER (PARTITION BY substr(canon, 1, 500), length(canon) >= 200) AS fn FROM uc),
ud AS (SELECT row_idx, CASE WHEN row_idx <> fe THEN 'exact_duplicate' WHEN cand AND row_idx <> fn THEN 'near_duplicate' END AS dup_reason FROM ue),
whole AS (SELECT deepened.*, dup_reason, CASE WHEN coalesce(strlen(masked), 0) < 10 THEN 'too_few_tokens' WHEN strlen(masked) > 2048 THEN 'too_many_tokens' END AS token_reason FROM deepened LEFT JOIN ud USING (row_idx))"""

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT row_idx, doc_id, url, text FROM mainpipe_ingested_v1",
    "scan_jsonl": "SELECT doc_id, text, source FROM documents",
    "scan_jsonl_typed": f"SELECT row_idx, url, {_KIND} AS kind, coalesce(length(text), -1)::BIGINT AS text_chars FROM mainpipe_ingested_v1",
    "drop_reason_typed": _PRE + f" SELECT row_idx, CASE WHEN {_KIND} = 'BIGINT' THEN 'non_string' ELSE drop_reason END AS drop_reason FROM pre",
    "head_lines": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 3",
    "fail_fast": "SELECT * FROM (VALUES ('missing_file', true), ('missing_column', true), ('present', false)) AS t(check_name, refused)",
    "scan_optional": "SELECT count(*) AS n FROM mainpipe_ingested_v1",
    "doc_id_sha1": "SELECT row_idx, sha1(coalesce(url, 'None') || '||' || coalesce(text, 'None')) AS doc_id, 'mainpipe_v1' AS source, '2025-01-01T00:00:00' AS ingest_ts FROM mainpipe_ingested_v1",
    "normalize_text": f"SELECT row_idx, {_norm('text')} AS text_norm FROM mainpipe_ingested_v1",
    "word_count": f"SELECT doc_id, len({_tok('text')})::BIGINT AS word_count, coalesce(length(text), 0)::BIGINT AS char_len FROM documents",
    "quality_metrics": f"""WITH t AS (SELECT doc_id, coalesce(text_norm, '') AS x, {_tok('text_norm')} AS tk FROM mainpipe_cleaned_v2)
SELECT doc_id, length(x)::BIGINT AS n_chars, len(tk)::BIGINT AS n_words, CASE WHEN x <> '' THEN round(length(regexp_replace(x, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(x), 9) ELSE 0 END AS alpha_ratio,
CASE WHEN len(tk) > 0 THEN round(1 - len(list_distinct(tk))::DOUBLE / len(tk), 9) ELSE 0 END AS repetition_ratio FROM t""",
    "non_latin_ratio": """WITH t AS (SELECT doc_id, length(regexp_replace(text_norm, '[^\\p{L}]', '', 'g')) AS a, length(regexp_replace(text_norm, '[^A-Za-z]', '', 'g')) AS b FROM mainpipe_cleaned_v2)
SELECT doc_id, CASE WHEN a > 0 THEN round((a - b)::DOUBLE / a, 9) ELSE 0 END AS non_latin_ratio FROM t""",
    "pii_hits_simple": f"SELECT doc_id, {_n('text_norm', _EMAIL)} AS email_hits, {_n('text_norm', chr(92) + '+?' + chr(92) + 'd[' + chr(92) + 'd' + chr(92) + '- ]{7,}' + chr(92) + 'd')} AS phone_hits FROM mainpipe_cleaned_v2",
    "toxicity_scores": f"WITH t AS (SELECT doc_id, {_TOK} AS tk FROM mainpipe_cleaned_v2) SELECT doc_id, round({_TOX_ALL}, 9) AS toxicity, CASE WHEN {_TOX_ALL} >= 0.9 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS severe_toxicity, "
    + ", ".join(f"round({_TOX[k]}, 9) AS {k}" for k in ("insult", "threat", "identity_attack", "sexual_explicit"))
    + " FROM t",
    "toxicity_lexicon": f"WITH t AS (SELECT doc_id, {_TOK} AS tk FROM mainpipe_cleaned_v2) SELECT doc_id, round({_OWN_ALL}, 9) AS toxicity, CASE WHEN {_OWN_ALL} >= 0.9 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS severe_toxicity, "
    + ", ".join(f"round({_OWN[k]}, 9) AS {k}" for k in ("insult", "threat", "identity_attack", "sexual_explicit")) + " FROM t",
    "toxicity_terms": f"WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM documents), n AS (SELECT term, count(*) AS n FROM t GROUP BY 1) SELECT category, x.term, coalesce(n, 0) AS n FROM (VALUES "
    + ", ".join(f"('{c}', '{w}')" for c, ws in _BAD.items() for w in ws.split()) + ") AS x(category, term) LEFT JOIN n ON n.term = x.term",
    "dedup_columns": "SELECT * FROM (VALUES ('doc_id', 'string'), ('text_pii_masked', 'string'), ('dedup_id', 'string'), ('exact_canon_text', 'string'), ('exact_hash', 'string'), ('near_key', 'string'), ('drop_reason', 'string'), ('is_dup_exact', 'boolean'), ('is_dup_near', 'boolean'), ('dup_of', 'string')) AS t(column_name, column_type)",
    "lang_detect": _LANG + " SELECT doc_id, lang_pred, round(lang_score, 9) AS lang_score FROM l",
    "strip_html": "SELECT row_idx, regexp_replace(text, '<[^>]+>', ' ', 'g') AS text FROM mainpipe_ingested_v1",
    "boilerplate": f"SELECT doc_id, {_boiler('text_deep_clean')} AS text FROM mainpipe_cleaned_v4",
    "repeat_chars": f"WITH r AS ({_repeats('mainpipe_cleaned_v2', 'doc_id', 'text_norm')}) SELECT v.doc_id, coalesce(r.out, v.text_norm) AS text FROM mainpipe_cleaned_v2 AS v LEFT JOIN r USING (doc_id)",
    "structural_cleanup": _DEEP_TEXT + " SELECT pre.row_idx, x.text_deep_clean AS text FROM pre LEFT JOIN x USING (row_idx)",
    "token_stats": f"""WITH t AS (SELECT doc_id, {_tok('text_deep_clean')} AS tk FROM mainpipe_cleaned_v4)
SELECT doc_id, len(tk)::BIGINT AS token_count, len(list_distinct(tk))::BIGINT AS unique_tokens, CASE WHEN len(tk) > 0 THEN round(len(list_distinct(tk))::DOUBLE / len(tk), 9) ELSE 0 END AS unique_token_ratio,
CASE WHEN len(tk) > 0 THEN round(len(list_filter(tk, lambda w: lower(w) IN ({_in(_STOP)})))::DOUBLE / len(tk), 9) ELSE 0 END AS stopword_ratio FROM t""",
    "token_spam": _SPAM + "SELECT row_idx, round(top, 9) AS top_share, len(tk) >= 3 AND top > 0.7 AS is_spam FROM u",
    "pii_mask": f"""SELECT doc_id, {_mask('text_deep_clean')} AS text_pii_masked, {_n('text_deep_clean', _EMAIL)} AS pii_email_hits, {_n('text_deep_clean', _PHONE)} AS pii_phone_hits, {_n('text_deep_clean', _CARD)} AS pii_cc_hits,
{_n('text_deep_clean', _IBAN)} AS pii_iban_hits, {_n('text_deep_clean', _EMAIL)} + {_n('text_deep_clean', _PHONE)} + {_n('text_deep_clean', _CARD)} + {_n('text_deep_clean', _IBAN)} > 0 AS has_pii FROM mainpipe_cleaned_v4""",
    **{f"pii_{k}": f"SELECT doc_id, {_n('text_deep_clean', p)} AS hits, regexp_replace(text_deep_clean, '{p}', '{m}', 'g') AS masked FROM mainpipe_cleaned_v4" for k, p, m in (("email", _EMAIL, "<EMAIL>"), ("phone", _PHONE, "<PHONE>"), ("cc", _CARD, "<CREDIT_CARD>"), ("iban", _IBAN, "<IBAN>"))},
    "canon_exact": f"SELECT doc_id, {_canon('text_pii_masked')} AS canon FROM mainpipe_cleaned_v4",
    "canon_near": f"SELECT doc_id, substr({_canon('text_pii_masked')}, 1, 500) AS near_key FROM mainpipe_cleaned_v4",
    "sha256": f"SELECT doc_id, sha256({_canon('text_pii_masked')}) AS exact_hash FROM mainpipe_cleaned_v4",
    "quality_score": _SCORED + " SELECT doc_id, quality_score, subset, mixture_name FROM sc",
    "subset": _SCORED + " SELECT doc_id, subset FROM sc",
    "model_quality": f"""WITH t AS (SELECT doc_id, url, text_norm, {_tok('text_norm')} AS ws, least(1.0::DOUBLE, coalesce(len(regexp_extract_all(text_norm, '!')), 0) / 10.0::DOUBLE) AS x FROM mainpipe_cleaned_v2)
SELECT doc_id, round(x, 9) AS toxicity, round(least(1.0::DOUBLE, length(text_norm) / 1000.0::DOUBLE), 9) AS model_q, coalesce(x >= 0.8 AND text_norm IS NOT NULL AND len(ws) BETWEEN 5 AND 5000
AND length(regexp_replace(text_norm, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(text_norm) >= 0.5 AND 1.0::DOUBLE - len(list_distinct(ws))::DOUBLE / len(ws) <= 0.8
AND NOT coalesce(regexp_matches(url, '/ads/|example-spam-site\\.com'), false) AND {_n('text_norm', _EMAIL)} + {_n('text_norm', _ROUGH)} <= 20, false) AS is_loud FROM t""",
    "text_fallback": f"SELECT v4.doc_id, {_FILLED.format('v2.text_norm')} AS text FROM mainpipe_cleaned_v4 AS v4 JOIN mainpipe_cleaned_v2 AS v2 USING (doc_id)",
    "pick_text": f"SELECT doc_id, coalesce(nullif({_trim('text_pii_masked')}, ''), nullif({_trim('text_deep_clean')}, ''), '') AS text FROM mainpipe_cleaned_v4",
    "tokenise": """SELECT doc_id, coalesce(strlen(text_pii_masked), 0)::BIGINT AS n_tokens, md5(coalesce(array_to_string(list_transform(generate_series(1, strlen(text_pii_masked)), lambda i: ('0x' || substr(hex(text_pii_masked), (2 * i - 1)::INT, 2))::BIGINT), ' '), '')) AS ids_in_order, true AS mask_fits,
CASE WHEN coalesce(strlen(text_pii_masked), 0) < 10 THEN 'too_few_tokens' WHEN strlen(text_pii_masked) > 2048 THEN 'too_many_tokens' END AS drop_reason FROM mainpipe_cleaned_v4""",
    "drop_reason_early": _PRE + " SELECT row_idx, coalesce(char_len, 0) AS char_len, word_count, drop_reason FROM pre",
    "drop_reason_lang": _LANG + " SELECT doc_id, lang_pred, drop_reason FROM r",
    "drop_reason_quality": _QUALITY + " SELECT row_idx, n_words, drop_reason FROM q",
    "drop_reason_deep": _DEEP_TEXT + " SELECT row_idx, token_count, drop_reason FROM dr",
    "drop_reason_pii": f"""WITH t AS (SELECT doc_id, has_pii, token_count, unique_token_ratio AS u, stopword_ratio AS s, {_tok('text_deep_clean')} AS tk FROM mainpipe_cleaned_v4)
SELECT doc_id, CASE WHEN len(tk) >= 3 AND list_max(map_values(list_histogram(tk)))::DOUBLE / len(tk) > 0.7 THEN 'repetitive_token_spam' WHEN token_count >= 10 AND u < 0.2 THEN 'low_unique_token_ratio'
WHEN token_count >= 10 AND s > 0.95 THEN 'high_stopword_ratio' WHEN has_pii THEN 'pii' END AS drop_reason FROM t""",
    "drop_reason_tokens": "SELECT doc_id, coalesce(strlen(text_pii_masked), 0)::BIGINT AS n_tokens, CASE WHEN coalesce(strlen(text_pii_masked), 0) < 10 THEN 'too_few_tokens' WHEN strlen(text_pii_masked) > 2048 THEN 'too_many_tokens' END AS drop_reason FROM mainpipe_cleaned_v4",
    "kept_dropped": _PRE + " SELECT row_idx, CASE WHEN drop_reason IS NULL THEN 'kept' ELSE 'dropped' END AS side FROM pre",
    "dropped_union": _QUALITY + " SELECT row_idx, drop_reason, word_count, -1::BIGINT AS n_words FROM pre WHERE drop_reason IS NOT NULL UNION ALL SELECT row_idx, drop_reason, -1, n_words FROM q WHERE drop_reason IS NOT NULL",
    "dedup_exact": _dedup(200, 500) + " SELECT doc_id, exact_hash, is_dup_exact FROM g",
    "dedup_near": _dedup(200, 500) + " SELECT doc_id, near_key, is_dup_near, drop_reason FROM g",
    "dedup_by_row_number": f"WITH c AS (SELECT row_idx, {_canon('text')} AS canon FROM mainpipe_ingested_v1), e AS (SELECT *, min(row_idx) OVER (PARTITION BY canon) AS fe, length(canon) >= 200 AS cand, min(row_idx) OVER (PARTITION BY substr(canon, 1, 500), length(canon) >= 200) AS fn FROM c) SELECT row_idx, row_idx::VARCHAR AS dedup_id, CASE WHEN row_idx <> fe THEN fe WHEN cand AND row_idx <> fn THEN fn END::VARCHAR AS dup_of FROM e",
    "dup_of": _dedup(200, 500) + " SELECT doc_id, doc_id AS dedup_id, dup_of, drop_reason FROM g",
    "dedup_summary": _dedup(200, 500) + " SELECT count(*) AS n_rows, count(*) FILTER (drop_reason IS NULL) AS kept, count(drop_reason) AS dropped, count(*) FILTER (is_dup_exact) AS exact_duplicates, count(*) FILTER (is_dup_near) AS near_duplicates FROM g",
    "drop_reason_counts": _PRE + " SELECT drop_reason, count(*) AS n FROM pre WHERE drop_reason IS NOT NULL GROUP BY 1",
    "stage_counts": _PRE + " SELECT count(*) AS n_in, count(*) FILTER (drop_reason IS NULL) AS n_kept, count(drop_reason) AS n_dropped FROM pre",
    "quality_summary": _summary("mainpipe_cleaned_v2", ["n_chars", "n_words", "alpha_ratio", "repetition_ratio"]),
    "token_summary": _summary("mainpipe_cleaned_v4", ["token_count", "unique_token_ratio", "stopword_ratio"], mean=False),
    "describe_lang_score": _describe("mainpipe_cleaned_v2", "lang_score"),
    "describe_token_count": _describe("mainpipe_cleaned_v4", "token_count"),
    "describe_n_chars": _describe("documents", "n_chars"),
    "describe_unique_token_ratio": _describe("mainpipe_cleaned_v4", "unique_token_ratio"),
    "describe_quality_score": _SCORED + " " + _describe("s", "q"),
    "subset_counts": _SCORED + " SELECT subset, count(*) AS n FROM sc GROUP BY 1",
    "pii_totals": "SELECT sum(pii_email_hits)::BIGINT AS pii_email_hits, sum(pii_phone_hits)::BIGINT AS pii_phone_hits, sum(pii_cc_hits)::BIGINT AS pii_cc_hits, sum(pii_iban_hits)::BIGINT AS pii_iban_hits, count(*) FILTER (has_pii) AS rows_with_pii FROM mainpipe_cleaned_v4",
    "pii_aggregate": """WITH u AS (SELECT v4.* FROM mainpipe_cleaned_v4 AS v4 UNION ALL SELECT v4.* FROM mainpipe_cleaned_v4 AS v4 WHERE doc_id IN (SELECT doc_id FROM mainpipe_cleaned_v5 WHERE drop_reason IS NOT NULL))
SELECT sum(pii_email_hits)::BIGINT AS pii_email_hits, sum(pii_phone_hits)::BIGINT AS pii_phone_hits, sum(pii_cc_hits)::BIGINT AS pii_cc_hits, sum(pii_iban_hits)::BIGINT AS pii_iban_hits, count(*) FILTER (has_pii) AS rows_with_pii FROM u""",
    "pii_rows": "SELECT doc_id, pii_email_hits, pii_phone_hits, pii_cc_hits, pii_iban_hits, has_pii FROM mainpipe_cleaned_v4",
    "pii_hit_hist": " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS counter, {c} AS hits, count(*) AS n FROM mainpipe_cleaned_v4 WHERE {c} IS NOT NULL GROUP BY 2 ORDER BY n DESC, hits LIMIT 30)" for c in ("pii_email_hits", "pii_phone_hits", "pii_cc_hits", "pii_iban_hits")),
    "csv_drop_counts": _PRE + " SELECT drop_reason, count(*) AS n FROM pre WHERE drop_reason IS NOT NULL GROUP BY 1",
    "sink_kept_dropped": _PRE + " SELECT row_idx, drop_reason, CASE WHEN drop_reason IS NULL THEN 'kept' ELSE 'dropped' END AS side FROM pre",
    "hist_quality_score": _SCORED + ", h AS (" + _hist("s", "q", 50).strip() + ") SELECT * FROM h",
    "hist_n_tokens": "WITH b0 AS (SELECT coalesce(strlen(text_pii_masked), 0) AS n FROM mainpipe_cleaned_v4), h AS (" + _hist("b0", "n", 80).strip() + ") SELECT * FROM h",
    "toy_shard": "SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_ids, least(count(*), 100) AS n_known, count(*) > 100 AS seeds_differ FROM documents",
    "clean_and_filter": _RUN + " SELECT row_idx, coalesce(text_norm, text) AS text, reason AS drop_reason, early IS NULL AS lang_is_pred FROM cleaned",
    "pipeline_reasons_bytes": _RUN + " SELECT row_idx, coalesce(reason, deep_reason, dup_reason, token_reason, 'kept') AS drop_reason FROM whole",
    "stream_clean": _RUN + " SELECT row_idx, coalesce(reason, deep_reason) AS drop_reason FROM deepened",
    "stream_window_counts": _PRE + " SELECT strftime(crawled_at, '%Y-%m-%d') AS day, coalesce(drop_reason, 'kept') AS reason, count(*) AS n FROM pre WHERE crawled_at IS NOT NULL GROUP BY ALL",
    "metrics_report": _SCORED + f""", one AS ({_describe('s', 'q')}), p AS (SELECT sum(pii_email_hits)::DOUBLE AS pii_email_hits, sum(pii_phone_hits)::DOUBLE AS pii_phone_hits, sum(pii_cc_hits)::DOUBLE AS pii_cc_hits, sum(pii_iban_hits)::DOUBLE AS pii_iban_hits, (count(*) FILTER (has_pii))::DOUBLE AS rows_with_pii FROM mainpipe_cleaned_v4)
SELECT 'quality_score' AS report, m AS metric, v AS value FROM (UNPIVOT (SELECT count::DOUBLE AS count, mean, std, min, p25, p50, p75, max FROM one) ON COLUMNS(*) INTO NAME m VALUE v)
UNION ALL SELECT 'pii', m, v FROM (UNPIVOT p ON COLUMNS(*) INTO NAME m VALUE v) UNION ALL SELECT 'drop_reasons', drop_reason, n::DOUBLE FROM (""" + _PRE + " SELECT drop_reason, count(*) AS n FROM pre WHERE drop_reason IS NOT NULL GROUP BY 1)",
    "low_info_counts": _DEEP_TEXT + " SELECT count(*) FILTER (token_count >= 10 AND u < 0.2) AS low_unique, count(*) FILTER (token_count >= 10 AND stop > 0.95) AS high_stopword, count(*) FILTER (drop_reason = 'repetitive_token_spam') AS token_spam FROM dr",
    "toxicity_report": _QUALITY + " SELECT count(*) AS n_rows, count(*) FILTER (drop_reason = 'high_toxicity') AS toxic_dropped, count(*) FILTER (drop_reason IS NULL) AS remaining, round(count(*) FILTER (drop_reason = 'high_toxicity') * 100.0::DOUBLE / count(*), 6) AS toxic_pct FROM q",
    "language_report": _LANG + " SELECT count(*) AS n_rows, count(*) FILTER (drop_reason = 'non_english') AS non_english_dropped, count(*) FILTER (drop_reason IS NULL) AS remaining, round(count(*) FILTER (drop_reason = 'non_english') * 100.0::DOUBLE / count(*), 6) AS non_english_pct FROM r",
    **{f"hist_{c}": _hist(t, c, n) for t, c, n in (("mainpipe_cleaned_v2", "char_len", 80), ("mainpipe_cleaned_v2", "word_count", 80), ("mainpipe_cleaned_v2", "lang_score", 50), ("mainpipe_cleaned_v2", "alpha_ratio", 50), ("mainpipe_cleaned_v2", "repetition_ratio", 50), ("mainpipe_cleaned_v4", "unique_token_ratio", 50), ("mainpipe_cleaned_v4", "stopword_ratio", 50), ("mainpipe_cleaned_v4", "token_count", 80))},
    "structural_counters": f"""WITH a AS (SELECT doc_id, text_norm AS t, regexp_replace(text_norm, '<[^>]+>', ' ', 'g') AS a FROM mainpipe_cleaned_v2),
b AS (SELECT *, {_boiler('a')} AS b, CASE WHEN a <> '' THEN regexp_split_to_array(regexp_replace(a, '(\\r\\n|[\\n\\r])$', ''), '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]') ELSE [] END AS ls FROM a),
r AS ({_repeats('b', 'doc_id', 'b')}),
z AS (SELECT b.*, len(list_filter(ls, lambda l: regexp_matches(lower(l), '{_BOILER}'))) AS gone, coalesce(r.out, b.b) AS c FROM b LEFT JOIN r USING (doc_id))
SELECT count(*) AS texts, count(*) FILTER (contains(t, '<') AND contains(t, '>')) AS had_tags, count(*) FILTER (a <> t) AS html_changed, sum(len(ls))::BIGINT AS lines_total, sum(gone)::BIGINT AS lines_removed,
count(*) FILTER (gone > 0) AS docs_with_removals, count(*) FILTER (c <> z.b) AS repeats_changed, count(*) FILTER (c <> t) AS changed FROM z""",
    "low_unique_examples": _DEEP_TEXT + " SELECT row_idx, token_count, round(u, 9) AS unique_token_ratio FROM dr WHERE token_count >= 10 AND u < 0.2 ORDER BY row_idx LIMIT 5",
    "shard_assign": f"SELECT doc_id, idx, (idx // 300 + 1)::BIGINT AS shard_id FROM ({_SHARDS})",
    "shard_manifest": f"WITH s AS (SELECT idx // 300 + 1 AS shard_id, n_tokens FROM ({_SHARDS})) SELECT shard_id::BIGINT AS shard_id, format('train_shard_{{:05d}}.jsonl', shard_id) AS filename, format('shards/train_shard_{{:05d}}.jsonl', shard_id) AS path, count(*) AS num_docs, sum(n_tokens)::BIGINT AS total_tokens FROM s GROUP BY shard_id",
    "shard_files": f"WITH s AS (SELECT idx // 300 + 1 AS shard_id, n_tokens FROM ({_SHARDS})) SELECT shard_id::BIGINT AS shard_id, format('train_shard_{{:05d}}.jsonl', shard_id) AS filename, count(*) AS num_docs, sum(n_tokens)::BIGINT AS total_tokens FROM s GROUP BY shard_id",
    "jsonl_clean": "SELECT doc_id, text_norm AS text, source FROM mainpipe_cleaned_v2",
    "jsonl_text_fallback": "SELECT doc_id, coalesce(nullif(text_pii_masked, ''), text_deep_clean) AS text, source FROM mainpipe_cleaned_v4",
    "jsonl_tokenised": _SCORED + " SELECT doc_id, url, subset, strlen(text_pii_masked)::BIGINT AS n_tokens, md5(coalesce(array_to_string(list_transform(generate_series(1, strlen(text_pii_masked)), lambda i: ('0x' || substr(hex(text_pii_masked), (2 * i - 1)::INT, 2))::BIGINT), ' '), '')) AS ids_in_order FROM sc WHERE strlen(text_pii_masked) BETWEEN 10 AND 2048",
    "jsonl_scored": _SCORED + f" SELECT doc_id, {_FILLED.format('text_norm')} AS text, source, quality_score, subset, mixture_name FROM sc",
    "export_text": _SCORED + f" SELECT * FROM (SELECT coalesce(nullif({_trim('text_pii_masked')}, ''), nullif({_trim('text_deep_clean')}, ''), nullif({_trim('text_norm')}, ''), '') AS text, doc_id, source, url, subset, mixture_name, quality_score FROM sc) WHERE text <> ''",
    "stream_reason_counts": _PRE + " SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS n FROM pre GROUP BY 1",
    "stream_dedup": f"SELECT DISTINCT sha256({_canon('text')}) AS exact_hash FROM documents",
}
