"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from textloom.functions.letters import (
    DEFAULT_ALPHABET,
    DISTRIBUTIONS,
    GERMAN_ALPHABET,
    alphabet_letters,
)
from textloom.plans import corpus as c
from textloom.plans.queries import FREQUENT, LITERAL, PATTERN

# The word pattern for scripts that part words by spaces, in RE2 syntax.
_L, _LS = r"[\p{L}\p{Nl}]", r"[\p{L}\p{Nl}\p{M}\p{Cf}]*"
_D, _DS = r"\p{Nd}", r"[\p{Nd}\p{M}\p{Cf}]*"
_J, _JS = r"\p{Pc}", r"[\p{Pc}\p{M}\p{Cf}]*"
_E = r"[\p{M}\p{Cf}]*"
_RUN = (
    rf"(?:{_L}{_LS}(?:[:.''‘’·]{_E}{_L}{_LS})*|{_D}{_DS}(?:[,;.''‘’]{_E}{_D}{_DS})*)+"
)
_WORD = rf"'{_RUN}(?:{_J}{_JS}(?:{_RUN})?)*|(?:{_J}{_JS}(?:{_RUN})?)+'"

_CORPUS = f"""
corpus AS (
  SELECT source AS remote, doc_id, 'data/' || dir || '/' || doc_id || '.txt' AS path,
         CAST(doc_id AS VARCHAR) AS ppn,
         CASE dir WHEN 'ft' THEN 'other' ELSE dir END AS doctype,
         CASE lang WHEN 'de' THEN 'ger' WHEN 'fr' THEN 'fre' WHEN 'en' THEN 'eng'
                   WHEN 'es' THEN 'spa' END AS lang_code,
         text, sha256(text) AS digest, substr(sha256(text), 1, 8) AS hash,
         strlen(text) AS size, {c.EPOCH} + doc_id AS mtime
  FROM (SELECT *, (['article', 'book', 'chapter', 'issue', 'ft', 'toc'])[doc_id % 6 + 1] AS dir
        FROM documents))"""
_ENTRY = "remote, path, hash, ppn, doctype, lang_code, size, mtime"
_ALLOW = """
allow AS (SELECT CAST(doc_id AS VARCHAR) AS ppn,
                 CASE toxic WHEN 1 THEN 'book' ELSE 'article' END AS kind
          FROM labels WHERE quality = 1)"""
_DENY = "deny AS (SELECT CAST(doc_id AS VARCHAR) AS ppn FROM labels WHERE toxic = 1)"


def _letters(text: str, letters: str) -> dict[str, str]:
    return {x: f"length({text}) - length(replace({text}, '{x}', ''))" for x in letters}


def _distances(source: str) -> str:
    counts = ", ".join(
        f"{e} AS n{i}" for i, e in enumerate(_letters("folded", GERMAN_ALPHABET).values())
    )
    parts = []
    for code, (alphabet, shares) in DISTRIBUTIONS.items():
        total = " + ".join(f"n{i}" for i in range(len(alphabet)))
        squares = " + ".join(
            f"pow(CASE WHEN t > 0 THEN n{i} / t ELSE 0 END - {s}, 2)".replace("t >", f"t_{code} >").replace(
                "/ t", f"/ t_{code}"
            )
            for i, s in enumerate(shares)
        )
        parts.append((f"({total})::DOUBLE AS t_{code}", f"sqrt({squares}) AS dist_{code}"))
    return f"""
folded AS (SELECT path, lower(nfc_normalize(text)) AS folded FROM {source}),
letters AS (SELECT path, {counts} FROM folded),
totals AS (SELECT *, {", ".join(p[0] for p in parts)} FROM letters),
distances AS (SELECT path, {", ".join(p[1] for p in parts)} FROM totals)"""


_STATS = f"""
listed AS (SELECT *, regexp_extract_all(text, {_WORD}) AS w FROM corpus),
stats AS (
  SELECT path, CAST(len(w) AS BIGINT) AS words, length(text) AS chars,
         round(CAST(CAST(CASE WHEN len(w) > 0
               THEN list_sum(list_transform(w, lambda x: strlen(x)))::DOUBLE / len(w) ELSE 0 END
               AS FLOAT) AS DOUBLE), 6) AS avg_word_len
  FROM listed)"""
_RATIOS = r"""
ratios AS (
  SELECT path,
         round(CASE WHEN text = '' THEN 0 ELSE
           length(regexp_replace(text, '\P{L}', '', 'g')) / length(text) END, 6) AS alpha,
         round(CASE WHEN text = '' THEN 0 ELSE
           length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(text) END, 6) AS alphanum
  FROM corpus)"""
def _lang(texts: str) -> str:
    """Fitted on the corpus, detected on ``texts`` with a ``path`` and a ``text``."""
    return rf"""
runs AS (SELECT lang_code, unnest(regexp_extract_all(lower(text), '\p{{L}}{{2,}}')) AS w FROM corpus),
fitted AS (SELECT lang_code, gram, count(*) AS n FROM (
             SELECT lang_code, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) AS gram
             FROM runs) GROUP BY ALL),
vocab AS (SELECT DISTINCT gram FROM fitted),
whole AS (SELECT lang_code, sum(n) AS n FROM fitted GROUP BY ALL),
rates AS (SELECT lang_code, (n + (SELECT count(*) FROM vocab))::DOUBLE AS rate FROM whole),
asked AS (SELECT path, unnest(regexp_extract_all(lower(text), '\p{{L}}{{2,}}')) AS w FROM {texts}),
times AS (SELECT path, gram, count(*) AS times FROM (
            SELECT path, unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) AS gram
            FROM asked) GROUP BY ALL),
scores AS (SELECT path, r.lang_code, sum(times * ln((coalesce(f.n, 0) + 1) / r.rate)) AS score
           FROM times CROSS JOIN rates r
           LEFT JOIN fitted f ON f.lang_code = r.lang_code AND f.gram = times.gram GROUP BY ALL),
best AS (SELECT path, max(score) AS top FROM scores GROUP BY path),
picked AS (SELECT s.path, arg_max(s.lang_code, s.score) AS lang_code,
                  1 / sum(exp(s.score - b.top)) AS lang_score
           FROM scores s JOIN best b USING (path) GROUP BY s.path),
detected AS (SELECT c.path, p.lang_code, round(p.lang_score, 6) AS lang_score
             FROM {texts} c LEFT JOIN picked p USING (path))"""


_TURNS = """
turns AS (SELECT 'data/chapter/' || conv_id || '-' || turn || '.txt' AS path, text FROM conversations)"""
_DIRS = "['article', 'book', 'chapter', 'issue', 'ft', 'toc']"
_SHARED = f"""
shared AS (
  SELECT 'documents' AS remote, path, text, mtime, size, digest FROM corpus
  UNION ALL SELECT 'pages', 'data/' || ({_DIRS})[page_id % 6 + 1] || '/' || page_id || '.txt', html,
                   {c.EPOCH} + page_id, strlen(html), sha256(html) FROM pages)"""


def _vocabulary(
    n: int,
    minimum: int = 2,
    keep: str = "true",
    having: str = "true",
    source: str = "corpus",
    ctes: str = "",
) -> str:
    lead = ", ".join(
        f"lead(token, {k}) OVER (PARTITION BY path ORDER BY pos) AS t{k}" for k in range(1, n)
    )
    joined = " || ' ' || ".join(["token"] + [f"t{k}" for k in range(1, n)])
    last = f"t{n - 1}" if n > 1 else "token"
    return f"""
WITH {_CORPUS}{ctes},
listed AS (SELECT path, regexp_extract_all(text, {_WORD}) AS w FROM {source}),
words AS (SELECT path, unnest(w) AS word, unnest(range(len(w))) AS pos FROM listed),
kept AS (SELECT path, pos, lower(word) AS token FROM words
         WHERE length(word) >= {minimum} AND {keep}),
windows AS (SELECT *{", " + lead if lead else ""} FROM kept),
whole AS (SELECT path, {joined} AS token FROM windows WHERE {last} IS NOT NULL)
SELECT token, CAST(count(*) AS BIGINT) AS tf, count(DISTINCT path) AS df
FROM whole GROUP BY token HAVING {having} ORDER BY tf DESC, df DESC, token"""


_STOP = f"""
stop AS (SELECT DISTINCT word FROM (
  SELECT unnest(regexp_extract_all(text, {_WORD})) AS word FROM benchmark)
  WHERE strlen(word) >= 2)"""
_NO_STOP = "lower(word) NOT IN (SELECT word FROM stop)"

# The identifier patterns in RE2 syntax.
_PATTERNS = {
    "isbn": r"(?i)ISBN(?:-1[03])?(?::?\s*)?\s((?:97[89][- ]?)?\d{1,5}[- ]?(?:\d+[- ]?){2}(?:\d|X))",
    "issn": r"(?i)ISSN(?::?\s*)?\s(\d{4}-\d{4})",
    "ddc": r"(?i)DDC\s+(\d{3}(?:\.\d+))(?:—dc23)",
    "orcid": r"(?i)(?:https?://orcid\.org/)(\d{4}-\d{4}-\d{4}-\d{3}(?:\d|X))",
    "isni": r"(?:https?://isni\.org/isni/)(\d{15}(?:\d|X))",
}


def _references(*kinds: str) -> str:
    def one(kind: str) -> str:
        p = _PATTERNS[kind]
        return f"""
SELECT path, '{kind}' AS type, regexp_extract(hit, '{p}', 1) AS value, "start",
       "start" + strlen(hit) AS "end"
FROM (SELECT path, hits[i] AS hit,
             CAST(list_sum(list_transform(gaps[1:i], lambda x: strlen(x)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: strlen(x))), 0) AS BIGINT) AS "start"
      FROM (SELECT path, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
            FROM (SELECT path, regexp_extract_all(text, '{p}') AS hits,
                         string_split_regex(text, '{p}') AS gaps FROM marked)))"""

    return rf"""
WITH {_CORPUS},
marked AS (SELECT path, 'ISSN 1234-' || lpad(ppn, 4, '0') || ' ISSN 123-4567 ' || text || chr(10)
  || 'ISBN 978-3-16-' || lpad(ppn, 6, '0')
  || '-0 und isbn: 3-16-148410-x, ISBN-13: 978 3 16 148410 0. issn: 4321-' || lpad(ppn, 4, '0')
  || ' DDC  ' || lpad(ppn, 3, '0') || '.5—dc23 DDC 005.74 https://orcid.org/0000-0002-' || lpad(ppn, 4, '0')
  || '-123X HTTP://ORCID.ORG/0000-0001-5000-0007 http://isni.org/isni/' || lpad(ppn, 15, '0') || 'X' AS text
  FROM corpus)
{" UNION ALL ".join(one(k) for k in kinds)}"""


_SIDES = f"""{_CORPUS},
idx AS (SELECT {_ENTRY} FROM corpus WHERE remote <> 'src3'),
edited AS (SELECT path, mtime + CASE lang_code WHEN 'spa' THEN 1 ELSE 0 END AS mtime,
                  text || CASE lang_code WHEN 'fre' THEN chr(10) ELSE '' END AS text
           FROM corpus WHERE remote <> 'src5'),
files AS (SELECT path, sha256(text) AS digest, mtime, strlen(text) AS size FROM edited)"""


def _violations(mode: int) -> str:
    more = ""
    if mode >= 1:
        more += " WHEN f.mtime <> i.mtime THEN 'mtime mismatch'"
    if mode >= 2:
        more += " WHEN f.size <> i.size THEN 'size mismatch'"
    return f"""
WITH {_SIDES}
SELECT path, reason FROM (
  SELECT i.path, CASE WHEN f.path IS NULL THEN 'file not found'
                      WHEN NOT starts_with(f.digest, i.hash) THEN 'hash mismatch'{more} END AS reason
  FROM idx i LEFT JOIN files f ON f.path = i.path) WHERE reason IS NOT NULL"""


_REMOTE_COLUMNS = "remote, path, hash, ppn, doctype, size, mtime"


def _remote(select: str) -> str:
    return f"""SELECT remote, path, substr(sha256(text), 1, 8) AS hash,
       ppn, doctype, strlen(text) AS size, mtime FROM ({select})"""


_REMOTES = f"""{_CORPUS},
r_documents AS (SELECT {_REMOTE_COLUMNS} FROM corpus WHERE size > 500 AND doctype <> 'toc'),
r_pages AS ({_remote('''SELECT 'pages' AS remote, 'data/other/' || page_id || '.txt' AS path,
       CAST(page_id AS VARCHAR) AS ppn, 'other' AS doctype, CAST(0 AS BIGINT) AS mtime, html AS text
       FROM pages''')}),
r_conversations AS (SELECT * FROM ({_remote('''SELECT 'conversations' AS remote,
       'data/chapter/' || conv_id || '-' || turn || '.txt' AS path, conv_id || '-' || turn AS ppn,
       'chapter' AS doctype, turn AS mtime, text FROM conversations''')}) WHERE size BETWEEN 100 AND 1000),
r_benchmark AS (SELECT * FROM ({_remote('''SELECT 'benchmark' AS remote,
       'data/toc/' || item_id || '.txt' AS path, CAST(item_id AS VARCHAR) AS ppn, 'toc' AS doctype,
       item_id AS mtime, text FROM benchmark''')}) WHERE size < 0),
r_items AS (SELECT * FROM ({_remote('''SELECT 'items' AS remote,
       'data/toc/' || item_id || '.txt' AS path, CAST(item_id AS VARCHAR) AS ppn, 'toc' AS doctype,
       item_id AS mtime, text FROM benchmark''')}) WHERE size > 0),
compound AS (SELECT * FROM r_documents UNION ALL SELECT * FROM r_pages
             UNION ALL SELECT * FROM r_conversations UNION ALL SELECT * FROM r_benchmark
             UNION ALL SELECT * FROM r_items)"""


def _summary(source: str) -> str:
    return f"""
SELECT remote, doctype, count(ppn) AS docs, CAST(sum(size) AS BIGINT) AS size,
       count(ppn) - count(DISTINCT hash) AS dups
FROM {source} GROUP BY remote, doctype"""


def _human(size: str) -> str:
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]
    cases = []
    for power, unit in enumerate(units):
        value = f"({size} / {float(1024**power)!r}::DOUBLE)"
        shown = (
            f"CASE WHEN {value} = floor({value}) THEN CAST(CAST({value} AS BIGINT) AS VARCHAR) "
            f"ELSE printf('%.2f', {value}) END || ' {unit}'"
        )
        bound = f"WHEN {size} < {float(1024 ** (power + 1))!r}::DOUBLE THEN" if unit != "EiB" else "ELSE"
        cases.append(f"{bound} {shown}")
    return f"CASE {' '.join(cases)} END"


_LINKS = """
links AS (SELECT CAST(l_partkey AS VARCHAR) AS target, count(DISTINCT l_orderkey) AS links
          FROM lineitem GROUP BY l_partkey)"""


def _authorities(kinds: dict[str, int], kind: str, links: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in kinds.items())
    return f"""
SELECT a.ppn, a.kind, '{c.URI_BASE}' || a.ppn AS uri, 'PPN: ' || a.ppn AS label, '' AS notation,
       coalesce(l.links, 0) AS links
FROM (SELECT CAST(p_partkey AS VARCHAR) AS ppn, {kind} AS kind FROM part) a
LEFT JOIN {links} l ON l.target = a.ppn
WHERE coalesce(l.links, 0) >= CASE a.kind {cases} ELSE 0 END ORDER BY a.ppn"""


_CODES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.AUTHORITY_CODES.items())
_CODE = f"CASE p_type {_CODES} END"
_KIND = f"""CASE substr({_CODE}, 1, 2) WHEN 'Tb' THEN 'corporate-body' WHEN 'Tf' THEN 'conference'
  WHEN 'Tg' THEN 'place-or-geo-name' WHEN 'Tp' THEN 'person' WHEN 'Ts' THEN 'subject-heading'
  WHEN 'Tu' THEN 'work' END"""
_RATINGS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.EVENT_RATINGS.items())
_ABOUT = "(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 20 + user_id % 20)"
_EVENTS = f"""
rated AS (
  SELECT event_id, 'data/' || (['article', 'book', 'chapter', 'issue', 'ft', 'toc'])[about % 6 + 1]
         || '/' || about || '.txt' AS path, '' AS hash,
         CASE event_type {_RATINGS} END AS rating, event_type AS comment,
         'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS username,
         'secret-' || user_id AS secret
  FROM (SELECT *, {_ABOUT} AS about FROM events))"""

ORACLE: dict[str, str] = {
    "doc_hash": f"WITH {_CORPUS} SELECT path, digest AS sha256, hash FROM corpus",
    "doc_stats": f"""WITH {_CORPUS}, {_STATS}
SELECT path, size, chars, words, avg_word_len FROM corpus JOIN stats USING (path)""",
    "doc_ratios": f"WITH {_CORPUS}, {_RATIOS} SELECT * FROM ratios",
    "path_parts": f"WITH {_CORPUS} SELECT path, ppn, doctype FROM corpus",
    "lang_code": f"WITH {_CORPUS} SELECT doc_id, lang_code FROM corpus",
    "lfreq_distance": f"""WITH {_CORPUS}, {_distances("corpus")}
SELECT path, round(dist_ger, 6) AS dist_ger, round(dist_eng, 6) AS dist_eng FROM distances""",
    "lang_detect": f"WITH {_CORPUS}, {_lang('corpus')} SELECT * FROM detected",
    "lang_detect_rare": f"WITH {_CORPUS}, {_lang('corpus')} SELECT * FROM detected",
    "lang_detect_turns": f"WITH {_CORPUS}, {_TURNS}, {_lang('turns')} SELECT * FROM detected",
    "index_shared_paths": f"""WITH {_CORPUS}, {_SHARED},
named AS (SELECT remote || '|' || path AS path, text FROM shared), {_lang('named')}
SELECT s.remote, s.path, substr(s.digest, 1, 8) AS hash, lang_code, lang_score, s.size
FROM shared s JOIN detected d ON d.path = s.remote || '|' || s.path""",
    "build_index": f"""WITH {_CORPUS}, {_STATS}, {_RATIOS}, {_distances("corpus")}, {_lang("corpus")}
SELECT remote, path, hash, ppn, doctype, d.lang_code, lang_score,
       round(CASE d.lang_code WHEN 'ger' THEN dist_ger WHEN 'eng' THEN dist_eng END, 6) AS lfreq,
       alpha, alphanum, words, avg_word_len, size, chars AS strlen, mtime
FROM corpus JOIN stats USING (path) JOIN ratios USING (path) JOIN distances USING (path)
JOIN detected d USING (path)""",
    "shrink_index": f"""WITH {_CORPUS}
SELECT CASE WHEN max(size) < 128 THEN 'tinyint' WHEN max(size) < 32768 THEN 'smallint'
            WHEN max(size) < 2147483648 THEN 'int' ELSE 'bigint' END AS size_type,
       CASE WHEN max(mtime) < 128 THEN 'tinyint' WHEN max(mtime) < 32768 THEN 'smallint'
            WHEN max(mtime) < 2147483648 THEN 'int' ELSE 'bigint' END AS mtime_type,
       CAST(sum(size) AS BIGINT) AS size_sum, CAST(sum(mtime) AS BIGINT) AS mtime_sum
FROM corpus""",
    "select_columns": f"WITH {_CORPUS} SELECT ppn, upper(doctype) AS kind, size * 8 AS bits FROM corpus",
    "select_where": f"WITH {_CORPUS} SELECT {_ENTRY} FROM corpus WHERE lang_code = 'ger' AND size > 1000",
    "select_sql_tail": f"""WITH {_CORPUS}
SELECT lang_code, doctype, count(*) AS docs, max(size) AS largest FROM corpus WHERE size > 100
GROUP BY lang_code, doctype HAVING count(*) > 2 ORDER BY docs DESC""",
    "select_subquery": f"""WITH {_CORPUS}
SELECT ppn, size FROM corpus WHERE size >= (SELECT avg(size) FROM corpus) AND doctype <> 'toc'""",
    "select_allow": f"""WITH {_CORPUS}, {_ALLOW}
SELECT ppn, path, size FROM corpus WHERE ppn IN (SELECT ppn FROM allow)""",
    "select_allow_multikey": f"""WITH {_CORPUS}, {_ALLOW}
SELECT path, hash FROM corpus
WHERE EXISTS (SELECT 1 FROM allow a WHERE a.ppn = corpus.ppn AND a.kind = corpus.doctype)""",
    "select_deny": f"""WITH {_CORPUS}, {_DENY}
SELECT ppn, path FROM corpus WHERE doctype <> 'toc' AND ppn NOT IN (SELECT ppn FROM deny)""",
    "select_append": f"""WITH {_CORPUS}
SELECT remote, ppn, doctype, size FROM corpus WHERE doctype = 'book'
UNION ALL SELECT remote, ppn, doctype, size FROM corpus WHERE size > 3000""",
    "snapshot_docs": f"""WITH {_CORPUS}
SELECT path, doctype, digest AS sha256 FROM corpus WHERE remote <> 'src3'""",
    "grep_match": f"WITH {_CORPUS} SELECT {_ENTRY} FROM corpus WHERE regexp_matches(text, '{PATTERN}')",
    "grep_invert": f"""WITH {_CORPUS}
SELECT {_ENTRY} FROM corpus WHERE NOT regexp_matches(text, '{PATTERN}')""",
    "grep_ignore_case": f"""WITH {_CORPUS}
SELECT {_ENTRY} FROM corpus WHERE regexp_matches(text, '(?i)ÉLE[^a-z]')""",
    "grep_prefix": f"""WITH {_CORPUS}
SELECT {_ENTRY} FROM corpus WHERE contains(text, '{LITERAL}')
AND strlen(substr(text, 1, strpos(text, '{LITERAL}') - 1)) + strlen('{LITERAL}') <= 100""",
    "grep_allow_deny": f"""WITH {_CORPUS}, {_ALLOW}, {_DENY}
SELECT {_ENTRY} FROM corpus WHERE regexp_matches(text, '{PATTERN}')
AND ppn IN (SELECT ppn FROM allow) AND ppn NOT IN (SELECT ppn FROM deny)""",
    "grep_relabel": f"""WITH {_CORPUS}
SELECT remote, path, hash, ppn, 'other' AS doctype, lang_code, size, mtime, 'seen' AS comment
FROM corpus WHERE regexp_matches(text, '{PATTERN}')""",
    "grep_header": f"""WITH {_CORPUS}
SELECT ppn, lang_code, CAST(length(path) AS INTEGER) AS path_len FROM corpus
WHERE lang_code <> 'eng' AND regexp_matches(text, '{PATTERN}')""",
    "grep_where_tail": f"""WITH {_CORPUS},
chosen AS (SELECT * FROM corpus WHERE size > (SELECT min(size) FROM corpus) ORDER BY size DESC, path LIMIT 50)
SELECT {_ENTRY} FROM chosen WHERE regexp_matches(text, '{PATTERN}')""",
    "ngram_unigrams": _vocabulary(1),
    "ngram_bigrams": _vocabulary(2),
    "ngram_trigrams": _vocabulary(3),
    "ngram_having": _vocabulary(
        2, having=f"count(*) >= {FREQUENT} AND count(DISTINCT path) >= {FREQUENT // 2}"
    ),
    "ngram_minlen": _vocabulary(1, 8),
    "ngram_category": _vocabulary(2, keep=r"regexp_matches(word, '[\p{Lu}\p{Lt}]')"),
    "ngram_stopwords": _vocabulary(2, keep=_NO_STOP, ctes=f", {_STOP}"),
    "ngram_stopwords_join": _vocabulary(3, keep=_NO_STOP, ctes=f", {_STOP}"),
    "ngram_stopwords_unigrams": _vocabulary(1, keep=_NO_STOP, ctes=f", {_STOP}"),
    "ngram_shared_paths": _vocabulary(
        2,
        keep=_NO_STOP,
        source="named",
        ctes=f", {_STOP}, {_SHARED}, named AS (SELECT remote || '|' || path AS path, text FROM shared)",
    ),
    "ngram_where_tail": _vocabulary(
        1,
        source="chosen",
        ctes=""", chosen AS (SELECT * FROM corpus WHERE lang_code IN (SELECT max(lang_code) FROM corpus)
ORDER BY path LIMIT 40)""",
    ),
    "ngram_allow_deny": _vocabulary(
        1,
        source="chosen",
        ctes=f""", {_ALLOW}, {_DENY}, chosen AS (SELECT * FROM corpus WHERE lang_code <> 'spa'
AND ppn IN (SELECT ppn FROM allow) AND ppn NOT IN (SELECT ppn FROM deny))""",
    ),
    **{f"refs_{k}": _references(k) for k in _PATTERNS},
    "refs_all": _references(*_PATTERNS),
    "refs_shared_paths": f"""WITH {_CORPUS}, {_SHARED}
SELECT remote, path, 'issn' AS type, '1234-567' || length(remote) AS value,
       CAST(0 AS BIGINT) AS "start", CAST(14 AS BIGINT) AS "end" FROM shared""",
    "refs_custom": f"""WITH {_CORPUS},
pieces AS (SELECT path, regexp_extract_all(text, 'the[a-z] ') AS hits,
                  string_split_regex(text, 'the[a-z] ') AS gaps FROM corpus),
found AS (SELECT path, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM pieces),
placed AS (SELECT path, substr(hits[i], 3, 2) AS value,
                  CAST(list_sum(list_transform(gaps[1:i], lambda x: strlen(x)))
                  + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: strlen(x))), 0) + 2 AS BIGINT) AS "start"
           FROM found)
SELECT path, 'tail' AS type, value, "start", "start" + 2 AS "end" FROM placed""",
    "inventory_status": f"""WITH {_SIDES}
SELECT * FROM (
  SELECT CASE WHEN f.path IS NULL THEN 'missing' WHEN i.path IS NULL THEN 'untracked'
              WHEN NOT (starts_with(f.digest, i.hash) AND f.mtime = i.mtime AND f.size = i.size)
              THEN 'changed' END AS status,
         starts_with(f.digest, i.hash) AS hash_ok, f.mtime = i.mtime AS mtime_ok,
         f.size = i.size AS size_ok, coalesce(i.path, f.path) AS path
  FROM idx i FULL JOIN files f ON f.path = i.path) WHERE status IS NOT NULL""",
    "status_shared_paths": f"""WITH {_CORPUS}, {_SHARED},
idx AS (SELECT remote, path, substr(digest, 1, 8) AS hash, mtime, size FROM shared WHERE remote = 'pages' OR size > 1000),
files AS (SELECT remote, path, digest, mtime, size FROM shared WHERE remote = 'documents' OR size > 3000)
SELECT * FROM (
  SELECT CASE WHEN f.path IS NULL THEN 'missing' WHEN i.path IS NULL THEN 'untracked' END AS status,
         starts_with(f.digest, i.hash) AS hash_ok, f.mtime = i.mtime AS mtime_ok, f.size = i.size AS size_ok,
         coalesce(i.remote, f.remote) AS remote, coalesce(i.path, f.path) AS path
  FROM idx i FULL JOIN files f ON f.path = i.path AND f.remote = i.remote) WHERE status IS NOT NULL""",
    "inventory_missing": f"""WITH {_SIDES}
SELECT {_ENTRY} FROM idx
WHERE path NOT IN (SELECT path FROM files)""",
    "inventory_untracked": f"""WITH {_SIDES}
SELECT path FROM files WHERE path NOT IN (SELECT path FROM idx) ORDER BY path""",
    "inventory_counts": f"""WITH {_SIDES}
SELECT (SELECT count(*) FROM idx WHERE path NOT IN (SELECT path FROM files)) AS missing,
       (SELECT count(*) FROM files WHERE path NOT IN (SELECT path FROM idx)) AS untracked""",
    "index_prune": f"""WITH {_SIDES}
SELECT {_ENTRY} FROM idx
WHERE path IN (SELECT path FROM files)""",
    "verify_permissive": _violations(0),
    "verify_strict": _violations(1),
    "verify_pedantic": _violations(2),
    "corpus_summary": f"WITH {_CORPUS} {_summary('corpus')}",
    "summary_compound": f"WITH {_REMOTES} {_summary('compound')}",
    "summary_json": f"""WITH {_REMOTES}, summed AS ({_summary("compound")}),
types AS (SELECT doctype, sum(docs) AS docs, sum(size) AS size, sum(dups) AS dups FROM summed GROUP BY doctype)
SELECT '{{' || string_agg('"' || doctype || '":{{"docs":' || docs || ',"size":' || size
       || ',"duplicates":' || dups || '}}', ',' ORDER BY doctype) || '}}' AS summary FROM types""",
    "summary_display": f"""WITH {_CORPUS}, summed AS ({_summary("corpus")})
SELECT remote, doctype AS kind, CAST(docs AS VARCHAR) AS docs, {_human("size")} AS size,
       CAST(dups AS VARCHAR) AS duplicates FROM summed""",
    "compound_index": f"WITH {_REMOTES} SELECT * FROM compound",
    "remote_counts": f"""WITH {_REMOTES}
SELECT 'documents' AS remote, count(*) AS docs FROM r_documents
UNION ALL SELECT 'pages', count(*) FROM r_pages
UNION ALL SELECT 'conversations', count(*) FROM r_conversations
UNION ALL SELECT 'benchmark', count(*) FROM r_benchmark
UNION ALL SELECT 'items', count(*) FROM r_items""",
    "compound_where_tail": f"""WITH {_REMOTES}
SELECT * FROM (SELECT {_REMOTE_COLUMNS} FROM corpus WHERE size > 0 ORDER BY size DESC, path LIMIT 30)
UNION ALL SELECT * FROM r_pages WHERE size > (SELECT avg(size) FROM r_pages)""",
    "authority_links": f"WITH {_LINKS} SELECT target, links FROM links",
    "authority_threshold": f"""WITH {_LINKS}
{_authorities({"STANDARD": 25, "LARGE": 30, "MEDIUM": 35, "ECONOMY": 40, "PROMO": 0}, "p_type", "links")}""",
    "authority_kind": f"""SELECT CAST(p_partkey AS VARCHAR) AS record_id, {_CODE} AS code, {_KIND} AS kind
FROM part""",
    "authority_records": """
SELECT CAST(target AS VARCHAR) AS target, count(*) AS links FROM (
  SELECT l_partkey AS target FROM lineitem
  UNION ALL SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey <> l_partkey)
GROUP BY target""",
    "authority_vocab": f"""WITH counted AS (
  SELECT CAST(l_partkey AS VARCHAR) AS target, count(*) AS links FROM lineitem GROUP BY l_partkey)
{_authorities({"corporate-body": 25, "conference": 30, "person": 40}, _KIND, "counted")}""",
    "authority_repeated": f"""
SELECT CAST(p_partkey AS VARCHAR) AS ppn, CASE WHEN p_partkey % 3 = 0 THEN 'work' ELSE {_KIND} END AS kind FROM part""",
    "record_filter": """
SELECT l_orderkey || '-' || l_linenumber AS record_id, count(*) AS records
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "record_similarity": """
SELECT p_partkey, round(similarity, 6) AS similarity, similarity >= 0.8 AS alike FROM (
  SELECT p_partkey, 1 - levenshtein(lower(p_name), 'small plate')::DOUBLE
                        / greatest(length(p_name), length('small plate')) AS similarity FROM part)""",
    "ratings_admission": f"""WITH {_CORPUS}, {_EVENTS},
users AS (SELECT c_name AS username, max(CASE WHEN c_acctbal >= 0 THEN 'secret-' ELSE 'changed-' END
                 || c_custkey) AS expected
          FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY c_name),
judged AS (
  SELECT r.*, CASE WHEN u.expected IS NULL THEN 'unknown user'
                   WHEN r.secret <> u.expected THEN 'wrong secret'
                   WHEN p.path IS NULL THEN 'unknown path'
                   WHEN rating NOT IN ('C', 'C-', 'P', 'P-', 'P+', 'I') THEN 'invalid rating'
              END AS reason
  FROM rated r LEFT JOIN users u USING (username)
  LEFT JOIN (SELECT DISTINCT path FROM corpus) p ON p.path = r.path)
SELECT path, username, event_id, hash, rating, comment, reason,
       CASE WHEN reason IS NULL THEN 'accepted'
            WHEN reason IN ('unknown user', 'wrong secret') THEN 'unauthorized'
            ELSE 'bad request' END AS status FROM judged""",
    "rating_worklist": f"""WITH {_CORPUS}
SELECT remote, path, hash, ppn FROM corpus
WHERE lang_code <> 'eng' AND doc_id NOT IN (SELECT doc_id FROM labels)""",
    "rating_latest": f"""WITH {_EVENTS}
SELECT 'events' AS remote, path, hash, rating, comment, username, event_id % 7 AS created_at
FROM (SELECT *, row_number() OVER (PARTITION BY path
        ORDER BY event_id % 7 DESC, username DESC, rating DESC, comment DESC, hash DESC) AS rn FROM rated)
WHERE rn = 1""",
}
_WIDE = ", ".join(
    f'{e} AS "{x}"' for x, e in _letters("folded", "".join(alphabet_letters(DEFAULT_ALPHABET))).items()
)
_ALL = " + ".join(f'"{x}"' for x in alphabet_letters(DEFAULT_ALPHABET))
ORACLE["letter_table"] = f"""
WITH {_CORPUS}, folded AS (SELECT path, nfc_normalize(lower(text)) AS folded FROM corpus),
counted AS (SELECT path, {_WIDE} FROM folded)
SELECT path, CAST({_ALL} AS BIGINT) AS total, * EXCLUDE (path) FROM counted"""
