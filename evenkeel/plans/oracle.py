"""The same queries in SQL, written independently for DuckDB, to check results against."""

from evenkeel.config import CONTRACTIONS, MEDICAL_SEEDS, NON_MEDICAL_SEEDS
from evenkeel.sources.templates import Vocabulary

# The whitespace class in RE2 syntax.
WS = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NOT_WS = WS.replace("[", "[^", 1)
LINKED = "concat('see [page ', url, '](', url, ') ', html)"


def _sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def _strip(x: str) -> str:
    return _sub(x, f"^{WS}+|{WS}+$")


def _link(x: str) -> str:
    return _sub(x, r"\[([^\]]+)\]\(([^)]+)\)", r"\1")


def _url(x: str) -> str:
    return _sub(x, rf"http{NOT_WS}+|www\.{NOT_WS}+")


def _tag(x: str) -> str:
    return _sub(x, "<[^>]+>")


def _quote(x: str) -> str:
    return _sub(x, "(?m)^&gt;.*$")


def _under(x: str) -> str:
    return _sub(x, "_{2,}")


def _collapse(x: str) -> str:
    return f"trim({_sub(x, WS + '+', ' ')})"


def _clean(x: str) -> str:
    return _collapse(_under(_quote(_tag(_url(_link(x))))))


def _truncate(x: str) -> str:
    kept = rf"length(regexp_extract(left({x}, 4000), '(?s)^(.*\. )', 1))"
    return (f"CASE WHEN length({x}) <= 4000 THEN {x} "
            f"WHEN {kept} - 2 > 2000 THEN left({x}, {kept} - 1) ELSE left({x}, 4000) END")


def _norm(x: str) -> str:
    return _sub(_strip(f"lower({x})"), WS + "+", " ")


def _key(purpose: str, row_id: str) -> str:
    return f"substr(md5(concat('42:{purpose}:', {row_id})), 1, 15)"


def _draw(purpose: str, row_id: str, number: int) -> str:
    digest = f"md5(concat('42:{purpose}{number // 4}:', {row_id}))"
    return f"cast(concat('0x', substr({digest}, {8 * (number % 4) + 1}, 8)) AS BIGINT)"


def _pick(values: list[str], draw: str) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}])[1 + ({draw} * {len(values)}) // 4294967296]"


def _cleaned(source: str) -> str:
    """CTEs t (cleaned, gated) and c (truncated) over ``source`` with columns ord, text, ..."""
    return f"""
    t AS (SELECT * REPLACE ({_clean("text")} AS text) FROM ({source})),
    c AS (SELECT * REPLACE ({_truncate("text")} AS text) FROM t
          WHERE length(text) BETWEEN 20 AND 16000),
    n AS (SELECT *, {_norm("text")} AS norm FROM c),
    k AS (SELECT *, md5(norm) AS ek, md5(left(norm, 200)) AS pk FROM n),
    s AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY ord) AS nth,
                 first_value(ek) OVER (PARTITION BY pk ORDER BY ord) AS kept_ek FROM k),
    kept AS (SELECT * EXCLUDE (norm, ek, pk, nth, kept_ek) FROM s WHERE nth = 1)"""


def _balanced(rows: str) -> str:
    return f"""
    counts AS (SELECT label, count(*) AS n FROM {rows} GROUP BY label),
    balanced AS (SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY label
                                     ORDER BY {_key("balance", "ord")}, ord) AS place FROM {rows})
        WHERE place <= (SELECT min(n) FROM counts))"""


def _allocated(rows: str) -> str:
    return f"""
    cells AS (SELECT label, source, count(*) AS n FROM {rows} GROUP BY label, source),
    named AS (SELECT label, source, n, CASE WHEN n < 3 THEN cast(label AS VARCHAR)
                     ELSE concat(label, '_', source) END AS stratum FROM cells),
    strata AS (SELECT stratum, cast(sum(n) AS BIGINT) AS n,
                      md5(concat('42:', stratum)) AS tie FROM named GROUP BY stratum),
    whole AS (SELECT cast(sum(n) AS BIGINT) AS total, cast(sum(n) AS BIGINT) * 4 // 5 AS want
              FROM strata),
    f1 AS (SELECT strata.*, total, want, n * want // total AS low, n * want % total AS rest
           FROM strata, whole),
    a1 AS (SELECT *, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, tie)
                     <= want - sum(low) OVER () THEN 1 ELSE 0 END AS train FROM f1),
    f2 AS (SELECT *, n - train AS more, total - want AS rest_total,
                  (total - want) // 2 AS want_val FROM a1),
    f3 AS (SELECT *, more * want_val // greatest(rest_total, 1) AS low_val,
                  more * want_val % greatest(rest_total, 1) AS rest_val FROM f2),
    sizes AS (SELECT stratum, n, cast(train AS BIGINT) AS train,
              cast(low_val + CASE WHEN row_number() OVER (ORDER BY rest_val DESC, tie)
                   <= want_val - sum(low_val) OVER () THEN 1 ELSE 0 END AS BIGINT) AS val FROM f3)"""


def _split(rows: str) -> str:
    return _allocated(rows) + f""",
    ranked AS (SELECT r.*, named.stratum, row_number() OVER (PARTITION BY named.stratum
               ORDER BY {_key("split", "ord")}, ord) AS place
               FROM {rows} r JOIN named USING (label, source)),
    assigned AS (SELECT ranked.*, CASE WHEN place <= train THEN 'train'
                 WHEN place <= train + val THEN 'val' ELSE 'test' END AS split
                 FROM ranked JOIN sizes USING (stratum))"""


def _decoded(x: str) -> str:
    """The entities that the pages hold."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"),
                         ("&nbsp;", "\xa0"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def _sample(rows: str, purpose: str, row_id: str, n: int) -> str:
    return f"(SELECT * FROM {rows} ORDER BY {_key(purpose, row_id)}, {row_id} LIMIT {n})"


LABELLED = """SELECT d.doc_id AS ord, d.text, cast(l.quality AS BIGINT) AS label, d.source
              FROM documents d JOIN labels l USING (doc_id)"""
DOCUMENTS = """SELECT doc_id AS ord, text, cast(CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS BIGINT)
               AS label, source, lang AS subtopic FROM documents"""
NARROW = """SELECT doc_id AS ord, cast(CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS BIGINT) AS label,
            source FROM documents"""
THIN = """SELECT doc_id AS ord, cast(CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS BIGINT) AS label,
          concat(lang, '-', cast(floor(log2(n_chars + 1)) AS INT)) AS source FROM documents"""
TURNS = "SELECT *, conv_id * 100000 + turn AS row_id FROM conversations"
EXCHANGES = """SELECT q.row_id, q.text AS question_1, a.text AS question_2
    FROM turns q LEFT JOIN turns a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
         AND a.role = 'assistant' WHERE q.role = 'user'"""


def _records(rows: str, text: str, label: int, source: str, subtopic: str | None, row_id: str) -> str:
    topic = f"'{subtopic}'" if subtopic else "cast(NULL AS VARCHAR)"
    return f"""SELECT text, cast({label} AS BIGINT) AS label, '{source}' AS source,
        {topic} AS subtopic, row_id FROM (SELECT {_strip(text)} AS text, {row_id} AS row_id
        FROM {rows}) WHERE text <> ''"""


def _walk(seeds: list[str], cap: int, target: int) -> str:
    first = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(seeds))
    names = ", ".join(f"'{s}'" for s in seeds)
    return f"""
    edges AS (SELECT r_name AS category, n_name AS title, 14 AS ns, cast(n_nationkey AS BIGINT) AS pos
              FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL
              SELECT n_name, c_name, 0, c_custkey
              FROM customer JOIN nation ON c_nationkey = n_nationkey),
    capped AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos, title) AS nth
               FROM edges QUALIFY nth <= {cap}),
    top AS (SELECT title, ns, (CASE category {first} END) * {cap} + nth - 1 AS place
            FROM capped WHERE category IN ({names})),
    sub AS (SELECT title, min(place) AS place FROM top WHERE ns = 14 GROUP BY title),
    below AS (SELECT c.title, c.ns, {len(seeds) * cap} + sub.place * {cap} + nth - 1 AS place
              FROM capped c JOIN sub ON c.category = sub.title),
    titles AS (SELECT title, cast(min(place) AS BIGINT) AS place
               FROM (SELECT * FROM top UNION ALL SELECT * FROM below) WHERE ns = 0
               GROUP BY title ORDER BY place LIMIT {target})"""


def _deep_walk(seeds: list[str], cap: int, target: int, depth: int) -> str:
    """As ``_walk`` on the tangled graph: a level has the categories that no level before it had."""
    names = ", ".join(f"('{s}', {i})" for i, s in enumerate(seeds))
    steps = [f"""
    segments AS (SELECT *, concat(n_name, '/', c_mktsegment) AS segment
                 FROM customer JOIN nation ON c_nationkey = n_nationkey),
    edges AS (SELECT r_name AS category, n_name AS title, 14 AS ns, n_nationkey AS pos
              FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT a.n_name, b.n_name, 14, -2 FROM nation a JOIN nation b
                  ON (a.n_nationkey * 7 + 3) % 25 = b.n_nationkey
        UNION ALL SELECT DISTINCT n_name, segment, 14, -1 FROM segments
        UNION ALL SELECT n_name, c_name, 0, c_custkey FROM segments WHERE c_custkey % 3 = 0
        UNION ALL SELECT n_name, c_name, 0, c_custkey + 500000 FROM customer JOIN nation
                  ON (c_nationkey + 1) % 25 = n_nationkey WHERE c_custkey % 5 = 0
        UNION ALL SELECT segment, c_name, 0, c_custkey FROM segments),
    capped AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos, title) AS nth
               FROM edges QUALIFY nth <= {cap}),
    f0(category, place) AS (VALUES {names})"""]
    base, seen = "0", []
    for level in range(depth + 1):
        steps.append(f"""m{level} AS (SELECT c.title, c.ns, {base} + f.place * {cap} + nth - 1 AS place
              FROM capped c JOIN f{level} f USING (category))""")
        base += f" + {len(seeds) * cap ** (level + 1)}" if level < 2 else f" + {cap} * (SELECT count(*) FROM f{level})"
        seen.append(f"SELECT category FROM f{level}")
        place = "min(place)" if level == 0 else "row_number() OVER (ORDER BY min(place), title) - 1"
        steps.append(f"""f{level + 1} AS (SELECT title AS category, {place} AS place FROM m{level}
              WHERE ns = 14 AND title NOT IN ({' UNION ALL '.join(seen)}) GROUP BY title)""")
    every = " UNION ALL ".join(f"SELECT * FROM m{level}" for level in range(depth + 1))
    return ", ".join(steps) + f""" SELECT title, cast(min(place) AS BIGINT) AS place FROM ({every})
        WHERE ns = 0 GROUP BY title ORDER BY place LIMIT {target}"""


def _seeded_walk(seeds: list[str], place: str, target: int) -> str:
    """Texts of the first articles below seeds, of which regions are some; 200 members a category count."""
    names = ", ".join("'" + s.replace("'", "''") + "'" for s in seeds)
    return f"""(WITH
    edges AS (SELECT ([{names}])[1 + {place}] AS category, n_name AS title, 14 AS ns, n_nationkey AS pos FROM nation
              UNION ALL SELECT n_name, c_name, 0, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
    capped AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos, title) AS nth FROM edges QUALIFY nth <= 200),
    top AS (SELECT title, (list_position([{names}], category) - 1) * 200 + nth - 1 AS place FROM capped WHERE ns = 14),
    titles AS (SELECT c.title, min({200 * len(seeds)} + t.place * 200 + nth - 1) AS place
               FROM capped c JOIN top t ON c.category = t.title WHERE c.ns = 0 GROUP BY c.title ORDER BY place LIMIT {target})
    SELECT text, place FROM titles JOIN customer ON c_name = title JOIN documents ON doc_id = c_custkey
    WHERE lang <> 'de' AND length(text) > 0 ORDER BY place LIMIT {target})"""


def _ten_sources() -> str:
    three = "concat(chr(10), chr(10), chr(10))"
    words = Vocabulary()
    filled = f"""replace(replace({_pick(words.templates, _draw('template', 'attempt', 1))}, '{{symptom}}',
        {_pick(words.symptoms, _draw('template', 'attempt', 2))}), '{{duration}}',
        {_pick(words.durations, _draw('template', 'attempt', 3))})"""
    tried = f"""SELECT attempt, CASE WHEN {_draw('template', 'attempt', 0)} < {int(0.75 * 2 ** 32)} THEN {filled}
        ELSE {_pick(words.questions, _draw('template', 'attempt', 4))} END AS text FROM (SELECT unnest(range(1400)) AS attempt)"""
    records = [
        _records("abstracts", "text", 1, "pubmed", "abstract", "row_id"),
        _records("pairs", "text", 1, "medquad", "qa_pair", "row_id"),
        _records("(SELECT * FROM documents WHERE lang <> 'es' AND text <> '' ORDER BY doc_id LIMIT 50)", "text", 1, "mtsamples",
                 "clinical_note", "doc_id"),
        _records(_seeded_walk(MEDICAL_SEEDS, "n_regionkey", 80), "text", 1, "wikipedia_medical", "article", "place"),
        _records("questions", "text", 1, "medquestionpairs", "patient_question", "row_id"),
        _records("(SELECT text, min(attempt) AS row_id FROM i7 GROUP BY text ORDER BY 2 LIMIT 70)", "text", 1,
                 "synthetic_casual", "templated_query", "row_id"),
        _records(_sample("documents", "agnews", "doc_id", 110), "text", 0, "agnews", "news", "doc_id"),
        _records(_sample("(SELECT * FROM documents WHERE lang <> 'de')", "newsgroups20", "doc_id", 45), "text", 0,
                 "newsgroups20", "forum_post", "doc_id"),
        _records(_sample("turns", "amazon_yelp/1", "row_id", 30),
                 "concat(CASE WHEN role <> 'system' THEN role ELSE '' END, ' ', text)", 0, "amazon_yelp", "amazon_review",
                 "row_id"),
        _records(_sample("documents", "amazon_yelp/2", "doc_id", 31), "text", 0, "amazon_yelp", "yelp_review", "doc_id"),
        _records(_seeded_walk(NON_MEDICAL_SEEDS, "6 - n_regionkey", 70), "text", 0, "wikipedia_nonmedical", "article", "place")]
    return f"""WITH turns AS ({TURNS}), x AS ({EXCHANGES}),
        parts AS (SELECT cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 25 AS topic, doc_id,
                  string_split(replace(text, '. ', concat('.', {three})), {three}) AS p FROM documents),
        chunks AS (SELECT topic, doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS raw FROM parts),
        told AS (SELECT topic, doc_id, pos, {_strip("raw")} AS text FROM chunks),
        shares AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY doc_id, pos) AS nth FROM told WHERE text <> ''),
        abstracts AS (SELECT text, row_number() OVER (ORDER BY topic, doc_id, pos) AS row_id FROM shares WHERE nth <= 3
                      QUALIFY row_id <= 75),
        s AS (SELECT row_id, row_id // 100000 % 3 AS folder, {_strip("question_1")} AS q, {_strip("question_2")} AS a FROM x),
        pairs AS (SELECT row_id, CASE WHEN q <> '' THEN concat(q, ' ', a) ELSE a END AS text FROM s
                  WHERE a <> '' AND folder < 2 ORDER BY folder, row_id LIMIT 60),
        u AS (SELECT {_strip("question_1")} AS text, row_id * 2 AS row_id FROM x UNION ALL
              SELECT {_strip("coalesce(question_2, '')")}, row_id * 2 + 1 FROM x),
        questions AS (SELECT text, min(row_id) AS row_id FROM u WHERE text <> '' GROUP BY text ORDER BY 2 LIMIT 90),
        {_informal(tried, "attempt")}
        SELECT text, label, source, subtopic FROM ({" UNION ALL ".join(f"SELECT * FROM ({r})" for r in records)})"""


def _generated() -> str:
    words = Vocabulary()
    template = _pick(words.templates, _draw("template", "o_orderkey", 1))
    draw = _draw("template", "o_orderkey", 2)
    symptom = f"""(SELECT list(n_name ORDER BY n_name) FROM nation)[
               1 + ({draw} * (SELECT count(*) FROM nation)) // 4294967296]"""
    duration = _pick(words.durations, _draw("template", "o_orderkey", 3))
    question = _pick(words.questions, _draw("template", "o_orderkey", 4))
    filled = f"replace(replace({template}, '{{symptom}}', {symptom}), '{{duration}}', {duration})"
    return f"""SELECT o_orderkey AS attempt, CASE WHEN {_draw("template", "o_orderkey", 0)}
               < {int(0.75 * 2 ** 32)} THEN {filled} ELSE {question} END AS text FROM orders"""


def _informal(rows: str, row_id: str) -> str:
    """CTEs i0 .. i7 over ``rows``; the last one holds the result."""
    steps = [f"i0 AS (SELECT {row_id}, concat(lower(left(text, 1)), substr(text, 2)) AS text "
             f"FROM ({rows}))"]
    for i, (old, new) in enumerate(CONTRACTIONS):
        old, new = old.replace("'", "''"), new.replace("'", "''")
        padded = "concat(' ', text, ' ')"
        steps.append(
            f"i{i + 1} AS (SELECT {row_id}, CASE WHEN {_draw('informal', row_id, i)} "
            f"< {int(0.4 * 2 ** 32)} AND contains({padded}, '{old}') "
            f"THEN {_strip(f'''replace({padded}, '{old}', '{new}')''')} ELSE text END AS text FROM i{i})")
    last = len(CONTRACTIONS)
    steps.append(f"i{last + 1} AS (SELECT {row_id}, CASE WHEN {_draw('informal', row_id, last)} "
                 f"< {int(0.3 * 2 ** 32)} AND ends_with(text, '?') "
                 f"THEN left(text, length(text) - 1) ELSE text END AS text FROM i{last})")
    return ",\n    ".join(steps)


def _title_lookup() -> str:
    return f"""WITH {_walk(["ASIA", "EUROPE"], 40, 350)}
    SELECT c_name AS title, text AS extract, place FROM titles JOIN customer ON c_name = title
    JOIN documents ON doc_id = c_custkey WHERE lang <> 'de' AND length(text) > 0
    ORDER BY place LIMIT 150"""


TURN_ROWS = f"({TURNS})"
BOTH = f"""SELECT text, label, source, subtopic, row_id AS ord
        FROM ({_records(TURN_ROWS, "text", 1, "turns", "question", "row_id")}) UNION ALL
    SELECT text, label, source, subtopic, row_id + (1::BIGINT << 55)
        FROM ({_records("documents", "text", 0, "corpus", "passage", "doc_id")})"""

HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
HIDDEN = r"'(?s)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>'"
PATH = "regexp_replace(url, '^[a-z]+://[^/?#]*', '')"

PERMITTED = """((host LIKE '%.com' AND path NOT LIKE '/fr/%' AND path NOT LIKE '/en/7%'
             AND path NOT LIKE '/de/%')
            OR (host LIKE '%.net' AND path NOT LIKE '/es/5%'
                AND (path NOT LIKE '/de/%' OR path LIKE '/de/1%')))"""
ARTICLES = f"""plain AS (SELECT page_id, regexp_replace(html, {HIDDEN}, '<x>', 'g') AS html
            FROM pages),
        regions AS (SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)(?:</article>|$)', 1) AS region
            FROM plain WHERE regexp_matches(html, '<article[^>]*>')),
        paragraphs AS (SELECT page_id, list_transform(
            string_split_regex(region, '<p(?:\\s[^>]*)?>')[2:],
            lambda p: regexp_extract(p, '(?s)^(.*?)(?:</p>|$)', 1)) AS ps FROM regions),
        nodes AS (SELECT page_id, flatten(list_transform(ps, lambda p: list_transform(
            string_split_regex(p, '<[^>]*>'), lambda t: {_strip(_decoded("t"))}))) AS ts FROM paragraphs),
        texts AS (SELECT page_id AS row_id, array_to_string(list_filter(ts, lambda t: t <> ''), ' ') AS text
            FROM nodes)"""

SQL = {
    "flagship_split": f"""WITH {_cleaned(LABELLED)}, {_balanced("kept")}, {_split("balanced")}
        SELECT ord, text, label, source, split FROM assigned""",
    "clean_gate_truncate": f"""WITH t AS (SELECT doc_id, {_clean("text")} AS text FROM documents)
        SELECT doc_id, {_truncate("text")} AS text FROM t WHERE length(text) BETWEEN 20 AND 16000""",
    "cleaned_keys": f"""WITH {_cleaned("SELECT doc_id, doc_id AS ord, text FROM documents")}
        SELECT doc_id, text, ek AS exact_key, pk AS prefix_key FROM k""",
    "md_link": f"SELECT page_id, {_link(LINKED)} AS text FROM pages",
    "strip_url": f"SELECT page_id, {_url(LINKED)} AS text FROM pages",
    "strip_tags": f"SELECT page_id, {_tag('html')} AS text FROM pages",
    "strip_quotes": f"""SELECT doc_id, {_quote("replace(text, '. ', concat('.', chr(10), '&gt; '))")}
        AS text FROM documents""",
    "strip_underscores": f"""SELECT doc_id,
        {_under("replace(replace(text, ' the ', '___'), ' de ', ' _ __ ')")} AS text FROM documents""",
    "collapse_ws": f"""SELECT doc_id, {_collapse(
        "replace(text, '. ', concat('.', chr(12288), chr(9), ' ', chr(8195)))")} AS text
        FROM documents""",
    "clean_text": f"SELECT page_id, {_clean(LINKED)} AS text FROM pages",
    "length_gate": """SELECT doc_id, length(text) AS chars FROM documents
        WHERE length(text) BETWEEN 20 AND 16000""",
    "truncate_sentence": f"SELECT doc_id, {_truncate('text')} AS text FROM documents",
    "normalise_keys": f"""WITH n AS (SELECT doc_id, {_norm("text")} AS norm FROM documents)
        SELECT doc_id, md5(norm) AS exact_key, md5(left(norm, 200)) AS prefix_key FROM n""",
    "make_records": _records("documents", """CASE WHEN lang = 'de' THEN concat(' ', chr(8195), chr(10))
        ELSE concat(chr(8195), chr(10), text, chr(9), chr(160)) END""", 1, "corpus", "prose", "doc_id"),
    "dedup_kept": f"WITH {_cleaned(DOCUMENTS)} SELECT text, label, source, subtopic, ord FROM kept",
    "dedup_counters": f"""WITH {_cleaned(DOCUMENTS)}
        SELECT count(*) AS before, count(*) FILTER (WHERE nth > 1 AND ek = kept_ek) AS exact,
               count(*) FILTER (WHERE nth > 1 AND ek <> kept_ek) AS near,
               count(*) FILTER (WHERE nth = 1) AS kept FROM s""",
    "sample_exact_n": f"SELECT * FROM {_sample('documents', 'sample', 'doc_id', 250)}",
    "sample_per_group": f"""SELECT doc_id, lang, source FROM documents
        QUALIFY row_number() OVER (PARTITION BY lang
                                   ORDER BY {_key("by-lang", "doc_id")}, doc_id) <= 40""",
    "first_n": "SELECT * FROM documents ORDER BY doc_id LIMIT 250",
    "quota_per_topic": """WITH d AS (SELECT doc_id, text,
            cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) AS topic_no FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY topic_no ORDER BY doc_id) AS nth FROM d)
        SELECT doc_id, topic_no, text FROM r WHERE nth <= 25 ORDER BY topic_no, doc_id LIMIT 200""",
    "label_counts": f"""SELECT label, count(*) AS "rows" FROM ({NARROW}) GROUP BY label""",
    "class_minimum": f"""SELECT min(n) AS minority
        FROM (SELECT count(*) AS n FROM ({NARROW}) GROUP BY label)""",
    "balance_classes": f"""WITH narrow AS ({NARROW}), {_balanced("narrow")}
        SELECT ord, label, source FROM balanced""",
    "rare_strata": f"""WITH thin AS ({THIN}), {_allocated("thin")}
        SELECT thin.ord, thin.label, thin.source, stratum FROM thin JOIN named USING (label, source)""",
    "split_targets": f"""WITH thin AS ({THIN}), {_allocated("thin")}
        SELECT stratum, n AS "rows", train, val, n - train - val AS test FROM sizes""",
    "stratified_split": f"""WITH thin AS ({THIN}), {_split("thin")}
        SELECT ord, label, source, split FROM assigned""",
    "source_breakdown": f"""WITH narrow AS ({NARROW}), {_balanced("narrow")}
        SELECT source, count(*) AS "rows" FROM balanced GROUP BY source ORDER BY 2 DESC, 1""",
    "stage_metrics": f"""WITH labelled AS ({LABELLED}), {_cleaned("SELECT * FROM labelled")},
        {_balanced("kept")}, {_split("balanced")},
        staged AS (SELECT 'combined' AS stage, source, label FROM labelled
            UNION ALL SELECT 'cleaned', source, label FROM c
            UNION ALL SELECT 'deduplicated', source, label FROM kept
            UNION ALL SELECT 'balanced', source, label FROM balanced
            UNION ALL SELECT split, source, label FROM assigned)
        SELECT stage, source, label, count(*) AS "rows" FROM staged GROUP BY stage, source, label""",
    "partial_round_trip": _records("documents", "text", 0, "corpus", None, "doc_id"),
    "csv_round_trip": f"""SELECT text, label, source, subtopic, subtopic AS split
        FROM ({DOCUMENTS})""",
    "source_union_priority": f"""WITH turns AS ({TURNS}),
        u AS ({_records("turns", "text", 1, "turns", "question", "row_id")}),
        d AS ({_records("documents", "text", 0, "corpus", None, "doc_id")})
        SELECT text, label, source, subtopic, row_id AS ord FROM u UNION ALL
        SELECT text, label, source, subtopic, row_id + (1::BIGINT << 55) FROM d""",
    "corpus_sample": _records(_sample("documents", "news", "doc_id", 250), "text", 0, "news", "news",
                              "doc_id"),
    "two_table_half_quota": f"""WITH turns AS ({TURNS})
        {_records(_sample("turns", "reviews/1", "row_id", 150),
                  "concat(CASE WHEN role <> 'system' THEN role ELSE '' END, ' ', text)", 0, "reviews",
                  "first", "row_id")} UNION ALL
        {_records(_sample("documents", "reviews/2", "doc_id", 151), "text", 0, "reviews", "second",
                  "doc_id + (1::BIGINT << 54)")}""",
    "category_exclude": _records(
        _sample("(SELECT * FROM documents WHERE lang NOT IN ('de', 'fr'))", "forum", "doc_id", 250),
        "text", 0, "forum", "forum_post", "doc_id"),
    "column_fallback": _records(
        "(SELECT * FROM documents WHERE lang <> 'es' ORDER BY doc_id LIMIT 250)", "text", 1, "notes",
        "clinical_note", "doc_id"),
    "unpivot_distinct": f"""WITH turns AS ({TURNS}), x AS ({EXCHANGES}),
        u AS (SELECT {_strip("question_1")} AS text, row_id * 2 AS row_id FROM x UNION ALL
              SELECT {_strip("coalesce(question_2, '')")}, row_id * 2 + 1 FROM x),
        firsts AS (SELECT text, min(row_id) AS row_id FROM u WHERE text <> '' GROUP BY text
                   ORDER BY 2 LIMIT 250)
        {_records("firsts", "text", 1, "questions", "question", "row_id")}""",
    "qa_pairs": f"""WITH turns AS ({TURNS}), x AS ({EXCHANGES}),
        s AS (SELECT row_id, {_strip("question_1")} AS q, {_strip("question_2")} AS a FROM x)
        SELECT cast(row_id AS VARCHAR) AS path, 0 AS pos,
               CASE WHEN q <> '' THEN concat(q, ' ', a) ELSE a END AS text FROM s WHERE a <> ''""",
    "xml_scan": f"""WITH turns AS ({TURNS}), x AS ({EXCHANGES}),
        s AS (SELECT row_id, row_id // 100000 % 3 AS folder, {_strip("question_1")} AS q, {_strip("question_2")} AS a
              FROM x),
        pairs AS (SELECT row_id, CASE WHEN q <> '' THEN concat(q, ' ', a) ELSE a END AS text FROM s
                  WHERE a <> '' AND folder < 2 ORDER BY folder, row_id LIMIT 160)
        SELECT * EXCLUDE (row_id) FROM ({_records("pairs", "text", 1, "files", "pair", "row_id")})""",
    "split_explode": f"""WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
        e AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS pos FROM p),
        s AS (SELECT doc_id, pos, {_strip("raw")} AS text FROM e)
        SELECT doc_id, pos, text FROM s WHERE text <> ''""",
    "json_decode": """SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "json_id_list": """SELECT o_orderkey, unnest([cast(o_orderkey AS VARCHAR),
        cast(o_custkey AS VARCHAR)]) AS id FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
    "json_members": """SELECT c_name AS category, c_name AS title, 0::BIGINT AS ns, 0::BIGINT AS pos
        FROM customer WHERE c_acctbal >= 0 UNION ALL
        SELECT c_name, concat('Category:', c_mktsegment), 14, 1 FROM customer WHERE c_acctbal >= 0""",
    "json_extracts": """SELECT page_id, CASE WHEN contains(url, '#') THEN '' ELSE html END AS extract
        FROM pages""",
    "category_walk": f"WITH {_walk(['ASIA', 'EUROPE'], 40, 350)} SELECT title, place FROM titles",
    "category_walk_seeds": f"""WITH {_walk(['AMERICA', 'AFRICA'], 40, 350)}
        SELECT title, place FROM titles""",
    "category_walk_deep": f"WITH {_deep_walk(['ASIA', 'PERU'], 40, 900, 3)}",
    "title_lookup": _title_lookup(),
    "link_extract": r"""WITH h AS (SELECT url,
            unnest(regexp_extract_all(html, '<a[^>]*\shref="([^"]*)"', 1)) AS href FROM pages)
        SELECT DISTINCT concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1),
            replace(href, '&amp;', '&')) AS link FROM h WHERE contains(href, '/th')""",
    "robots_filter": f"""WITH p AS (SELECT page_id, url, {HOST} AS host, {PATH} AS path FROM pages)
        SELECT page_id, url FROM p WHERE {PERMITTED}""",
    "article_text": f"WITH {ARTICLES} SELECT row_id, text FROM texts WHERE length(text) > 100",
    "crawl_source": f"""WITH {ARTICLES},
        p AS (SELECT page_id, url, {HOST} AS host, {PATH} AS path FROM pages),
        articles AS (SELECT row_id, text FROM texts JOIN p ON row_id = page_id
            WHERE length(text) > 100 AND page_id % 3 <> 0 AND contains(url, '/en/') AND {PERMITTED}
            ORDER BY row_id LIMIT 30)
        {_records("articles", "text", 0, "crawl", "article", "row_id")}""",
    "pipeline_build": f"""WITH {_cleaned(BOTH)}, {_balanced("kept")}, {_split("balanced")}
        SELECT text, label, source, subtopic, split FROM assigned""",
    "skip_collect": f"""WITH {_cleaned(BOTH)}, {_balanced("kept")}, {_split("balanced")}
        SELECT text, label, source, subtopic, split FROM assigned""",
    "build_counts": f"""WITH both_sources AS ({BOTH}), {_cleaned("SELECT * FROM both_sources")},
        {_balanced("kept")}, {_split("balanced")},
        staged AS (SELECT 'combined' AS stage, source, label FROM both_sources
            UNION ALL SELECT 'cleaned', source, label FROM c
            UNION ALL SELECT 'deduplicated', source, label FROM kept
            UNION ALL SELECT 'balanced', source, label FROM balanced
            UNION ALL SELECT split, source, label FROM assigned)
        SELECT stage, source, label, count(*) AS "rows" FROM staged GROUP BY stage, source, label""",
    "reuse_status": f"""WITH stored AS (SELECT source, count(*) AS n FROM ({BOTH}) GROUP BY source),
        told(run, source, status) AS (VALUES
            (0, 'turns', 'built'), (0, 'corpus', 'built'), (0, 'nothing', 'empty'),
            (1, 'turns', 'reused'), (1, 'corpus', 'reused'), (1, 'nothing', 'empty'),
            (2, 'turns', 'built'), (2, 'corpus', 'failed'), (2, 'nothing', 'empty'), (3, 'corpus', 'built'))
        SELECT cast(run AS BIGINT) AS run, told.source, status, coalesce(n, 0) AS "rows"
        FROM told LEFT JOIN stored USING (source)""",
    "rebuild_keeps_rows": _records("documents", "text", 0, "corpus", "passage", "doc_id"),
    "only_subset": f"SELECT text, label, source, subtopic, ord FROM ({BOTH}) WHERE source = 'corpus'",
    "csv_scan": f"""SELECT * EXCLUDE (row_id) FROM ({_records(
            "(SELECT * FROM documents WHERE lang <> 'es' AND text <> '' ORDER BY doc_id LIMIT 150)", "text", 1,
            "both", "clinical_note", "doc_id")}) UNION ALL
        SELECT * EXCLUDE (row_id) FROM ({_records(
            "(SELECT * FROM documents WHERE text <> '' ORDER BY doc_id LIMIT 150)", "text", 1, "second",
            "clinical_note", "doc_id")})""",
    "ten_sources": _ten_sources(),
    "template_fill": f"""WITH {_informal(_generated(), "attempt")} SELECT attempt, text FROM i7""",
    "template_generate": f"""WITH {_informal(_generated(), "attempt")}
        SELECT text, min(attempt) AS attempt FROM i7 GROUP BY text ORDER BY 2 LIMIT 500""",
    "informalise": f"""WITH turns AS ({TURNS}), casual AS (SELECT row_id, regexp_replace(
            replace(replace(replace(replace(text, ' de ', ' don''t '), ' the ', ' it''s '),
            ' la ', ' can''t '), ' of ', ' i''m '), '\\.\\z', '?') AS text FROM turns),
        {_informal("SELECT * FROM casual", "row_id")} SELECT row_id, text FROM i7""",
}
