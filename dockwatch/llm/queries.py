"""Registered queries of the subpackage: one per operator, over whole tables, and the SQL where SQL can express them."""

from pyspark.sql import functions as F

from dockwatch.llm.common import read_table
from dockwatch.session import fixed_rows, new_folder

QUERIES, ORACLES = {}, {}
SHARDS = 40


def register(name, sql=None):
    def wrap(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return wrap


RULES_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
rep AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS at FROM win SEMI JOIN rep USING (doc_id, g)),
covered AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
m AS (SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(text, '[^a-z]', '', 'g')) AS low
      FROM t LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 40 * n_lines
            OR (up + low >= 20 AND 100 * up > 60 * (up + low)) OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""


@register("op5_quality_rules", RULES_SQL)
def op5_quality_rules(spark, sf_dir):
    """Counts of every whole text, the base verdict and the verdict of the cascade."""
    from dockwatch.llm.op05_rules import quality_rules

    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules(read_table(spark, sf_dir, "documents"), report=shown)
    base = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return judged.select("doc_id", *shown, base.alias("base_failed"), "kept")


#: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URLS_SQL = """
WITH r AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS t(h, p, v)),
u AS (SELECT page_id, row_number() OVER () AS k, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, k, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
f AS (SELECT s.k, r.*, row_number() OVER (PARTITION BY s.k ORDER BY length(h || p) DESC, length(h) DESC) AS place
      FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN (SELECT * FROM f WHERE place = 1) USING (k)
"""


@register("op7_url_filters", URLS_SQL)
def op7_url_filters(spark, sf_dir):
    """Every page's host, path, winning rule and verdict; pages that no rule fits are allowed."""
    from dockwatch.llm.op07_urls import filter_urls

    rules = fixed_rows(spark, URL_RULES, {"host": "string", "path": "string", "verdict": "string"})
    return filter_urls(read_table(spark, sf_dir, "pages"), rules)


@register("op9_sharding")
def op9_sharding(spark, sf_dir):
    """All documents in 40 shards whose row counts differ by one at most, each with the mixture of sources."""
    from dockwatch.llm.op09_shards import interleaved_shards

    placed = interleaved_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")


@register("op10_nearest")
def op10_nearest(spark, sf_dir):
    """The five nearest by cosine of every vector whose id is divisible by 50, against all vectors."""
    from dockwatch.llm.op10_ann import nearest

    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@register("op3_token_ids")
def op3_token_ids(spark, sf_dir):
    """Every whole text encoded, written as a token set, and read back from its frames."""
    from dockwatch.llm.op03_tokens import read_tokens, write_tokens
    from dockwatch.llm.tokens import tokenizer_file

    path = write_tokens(read_table(spark, sf_dir, "documents"), new_folder(spark, "tokens"), tokenizer_file())
    return read_tokens(spark, path, digest=True)


@register("op6_near_duplicates")
def op6_near_duplicates(spark, sf_dir):
    """Components of all documents whose sets of three-word shingles are alike by 0.85 or more."""
    from dockwatch.llm.op06_neardup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), k=3, num=85, den=100)


@register("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    """Score of every whole text, learnt from the labels of rows that are not held out."""
    from dockwatch.llm.op01_gam import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op2_packing")
def op2_packing(spark, sf_dir):
    """All documents in length buckets of least padding and batches of 32,768 tokens."""
    from dockwatch.llm.op02_packing import pack_documents
    from dockwatch.llm.tokens import tokenizer_file

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file())


#: Domain -> share of the tokens.
MIXTURE = {"clean": 0.9, "toxic": 0.07, "junk": 0.03}


def domain_labels(labels):
    """The labelled table of the mixture: toxic texts, other good texts, other bad texts."""
    return labels.select("doc_id", F.expr("case when toxic = 1 then 'toxic' when quality = 1 then 'clean' when quality = 0 then 'junk' end").alias("domain"))


@register("op8_mixing")
def op8_mixing(spark, sf_dir):
    """Posterior, rate and copies of every document for the target mixture."""
    from dockwatch.llm.op08_mixing import mixture_rates

    return mixture_rates(read_table(spark, sf_dir, "documents"), domain_labels(read_table(spark, sf_dir, "labels")), MIXTURE)


@register("op4_main_text")
def op4_main_text(spark, sf_dir):
    """Main text of every page."""
    from dockwatch.llm.op04_html import extract_main_text

    return extract_main_text(read_table(spark, sf_dir, "pages"))


@register("op11_token_counts")
def op11_token_counts(spark, sf_dir):
    """Bytes and tokens of every whole text, counted by the compiled tokenizer."""
    from dockwatch.llm.op11_counts import token_counts
    from dockwatch.llm.tokens import tokenizer_file

    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file())

def crc32_sql(codes):
    """CRC-32 of a list of byte values; its table follows from the generator polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    step = f"xor(a >> 8, list_extract({table}, (xor(a, b) & 255) + 1)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"


def resampling_sql():
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = """unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
 list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))"""
    codes = "list_transform(range(1, 2 * strlen(g), 2), lambda i: ('0x' || substr(hex(encode(g)), i, 2))::BIGINT)"
    return f"""WITH d AS (SELECT doc_id, row_number() OVER () AS k, {words} AS w FROM documents),
f AS (SELECT k, {runs} AS g FROM d), e AS (SELECT {runs} AS g FROM (SELECT {words} AS w FROM benchmark)),
c AS MATERIALIZED (SELECT g, {crc32_sql(codes)} % 10000 AS b FROM (SELECT g FROM f UNION SELECT g FROM e)),
fb AS (SELECT k, b FROM f JOIN c USING (g)),
s AS (SELECT b, count(*) AS s FROM fb GROUP BY b), t AS (SELECT b, count(*) AS t FROM e JOIN c USING (g) GROUP BY b),
tot AS (SELECT (SELECT sum(s) FROM s)::DOUBLE AS sa, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS ta),
gain AS (SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (sa + 10000) / ((s + 1.0::DOUBLE) * (ta + 10000))))::BIGINT AS gain
 FROM s LEFT JOIN t USING (b), tot),
w AS (SELECT k, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM fb JOIN gain USING (b) GROUP BY k),
x AS (SELECT doc_id, len(w) AS n, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
 ('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS h FROM d LEFT JOIN w USING (k)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n >= 20 AS may FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) FILTER (may) OVER () AS every FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 5 * every // 100 THEN place END::BIGINT AS rank FROM z"""


@register("op12_resampling", resampling_sql())
def op12_resampling(spark, sf_dir):
    """All documents scored towards the benchmark texts; five in a hundred are drawn."""
    from dockwatch.llm.op12_resampling import resample

    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def tampered_text():
    """Lower-case A-Z of the text where 3 divides the CRC-32 of the id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def manifest_sql(levels=7, top=2, fanout=8):
    """Levels are written out one by one: seven inside a language (2 million documents each), two over the languages."""
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    given = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"d AS (SELECT *, row_number() OVER () AS k, coalesce({crc32_sql(codes)} % 3 = 0, false) AS hit FROM documents)",
        f"""l AS (SELECT k, doc_id, lang, sha256({' || '.join(fields)} || {given.format('text')}) AS leaf,
 sha256({' || '.join(fields)} || {given.format(f'CASE WHEN hit THEN {lower} ELSE text END')}) AS later FROM d)""",
        """p AS (SELECT *, coalesce(lang, '') AS g, lang IS NOT NULL AS named, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS i,
 count(*) OVER (PARTITION BY lang) AS n FROM l)""",
        "a0 AS (SELECT named, g, i, n, leaf AS h FROM p)"]

    def climb(name, keys, k):
        many = f"{fanout}"
        return [
            f"r{name}{k} AS MATERIALIZED (SELECT {keys} i // {many} AS i, any_value(n) AS n, list(h ORDER BY i) AS hs FROM {name}{k} GROUP BY {keys} i // {many})",
            f"{name}{k + 1} AS (SELECT {keys} i, (n + {fanout - 1}) // {many} AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM r{name}{k})"]

    for k in range(levels):
        parts += climb("a", "named, g,", k)
    parts.append(f"b0 AS (SELECT row_number() OVER (ORDER BY named, g) - 1 AS i, count(*) OVER () AS n, h, named, g FROM a{levels})")
    for k in range(top):
        parts += climb("b", "", k)
    joins, at = ["p JOIN b0 s USING (named, g)"], []
    for name, keys, place, count in (("a", True, "p.i", levels), ("b", False, "s.i", top)):
        for k in range(count):
            r = f"r{name}{k}"
            joins.append(f"JOIN {r} ON {f'{r}.named = p.named AND {r}.g = p.g AND ' if keys else ''}{r}.i = {place} // {fanout**(k + 1)}")
            at.append((r, f"({place} // {fanout**k}) % {fanout}"))
    sides = [(f"CASE WHEN {r}.n > 1 THEN array_to_string({r}.hs[1:{d}], '') ELSE '' END", f"CASE WHEN {r}.n > 1 THEN array_to_string({r}.hs[{d} + 2:], '') ELSE '' END", r) for r, d in at]
    shown = ", ".join(f"{a} AS x{i}, {b} AS y{i}, {r}.n > 1 AS z{i}" for i, (a, b, r) in enumerate(sides))
    parts.append(f"j AS (SELECT doc_id, leaf, later AS f0, s.h AS subroot, (SELECT h FROM b{top}) AS root, {shown} FROM {' '.join(joins)})")
    for i in range(len(sides)):
        before = "j" if i == 0 else f"f{i}_"
        parts.append(f"f{i + 1}_ AS (SELECT * EXCLUDE (f0), CASE WHEN z{i} THEN sha256(x{i} || f0 || y{i}) ELSE f0 END AS f0 FROM {before})")
    proof = " || ".join(f"x{i} || y{i}" for i in range(len(sides)))
    return f"""WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f0 AS folded_root, f0 = root AS verified FROM f{len(sides)}_"""


@register("op13_manifest", manifest_sql())
def op13_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document, and whether its later state still folds to the root."""
    from dockwatch.llm.op13_manifest import manifest

    return manifest(read_table(spark, sf_dir, "documents"), changed={"text": tampered_text()})
