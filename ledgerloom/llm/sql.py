"""Checking SQL of the queries, for DuckDB."""

# Independent of the operator's variants: lines that share their first or last half are compared word by word.
OP3_LINE_DEDUP = r"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ln FROM documents
), named AS (
  SELECT doc_id, ln, line, list_filter(regexp_split_to_array(lower(line), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM raw
), firsts AS (
  SELECT words, min((doc_id, ln)) AS first FROM named WHERE len(words) >= 1 GROUP BY words
), numbered AS (
  SELECT row_number() OVER (ORDER BY first) AS id, words, first, len(words) AS n FROM firsts
), halves AS (
  SELECT DISTINCT id, n, side, h, CASE WHEN side = 0 THEN words[1:h] ELSE words[n - h + 1:n] END AS half
  FROM (SELECT *, unnest([n // 2, (n - 1) // 2]) AS h FROM numbered WHERE n >= 5), (SELECT unnest([0, 1]) AS side)
), pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM halves a JOIN halves b USING (side, h, half) WHERE a.id < b.id AND abs(a.n - b.n) <= 1
), ends AS (
  SELECT p.b, x.n AS m, y.n AS n,
    coalesce(list_min(list_filter(range(1, least(x.n, y.n) + 1), lambda i: x.words[i] <> y.words[i])) - 1, least(x.n, y.n)) AS front,
    coalesce(list_min(list_filter(range(1, least(x.n, y.n) + 1), lambda i: x.words[x.n + 1 - i] <> y.words[y.n + 1 - i])) - 1, least(x.n, y.n)) AS back
  FROM pairs p JOIN numbered x ON p.a = x.id JOIN numbered y ON p.b = y.id
), near AS (
  SELECT DISTINCT b AS id FROM ends WHERE front + back >= greatest(m, n) - 1
), judged AS (
  SELECT l.doc_id, l.ln, l.line, f.id IS NOT NULL AND (near.id IS NOT NULL OR f.first <> (l.doc_id, l.ln)) AS gone
  FROM named l LEFT JOIN numbered f ON l.words = f.words LEFT JOIN near ON f.id = near.id
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  md5(coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (NOT gone), '')) AS text_md5
FROM judged GROUP BY doc_id
"""

OP1_QUALITY_RULES = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, i, words[i:i + 7] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base)
), covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS k FROM starts), range(8) AS r(o) WHERE k > 1 GROUP BY doc_id
), listed AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM base
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM listed WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), plain AS (
  SELECT doc_id, source, text, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS p,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM listed
), common AS (
  SELECT source, p FROM plain JOIN (SELECT source, count(DISTINCT text) AS docs FROM base GROUP BY source) USING (source)
  WHERE p <> '' GROUP BY source, p, docs HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.01 * docs
), lost AS (
  SELECT doc_id, sum(n) AS n FROM plain JOIN common USING (source, p) GROUP BY doc_id
), stats AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS boilerplate_words
  FROM base LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, base_failed = false AND n_words - boilerplate_words >= 20 AND n_words - boilerplate_words >= 0.3 * n_words AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats)
"""


def op6_license_scan(templates: tuple[tuple[str, str, str], ...]) -> str:
    """Every window of every length, without bands: shingles that windows and templates share are counted."""
    quoted = [tuple(x.replace("'", "''") for x in t) for t in templates]
    values = ", ".join(f"({i}, '{name}', '{text}', '{telling}')" for i, (name, text, telling) in enumerate(quoted))
    return rf"""
WITH template AS (
  SELECT id, license, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words,
    list_filter(regexp_split_to_array(lower(told), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS told FROM (VALUES {values}) AS v(id, license, t, told)
), telling AS (
  SELECT DISTINCT id, told[i:i + 2] AS s, true AS must FROM (SELECT id, told, unnest(range(1, len(told) - 1)) AS i FROM template)
), wanted AS (
  SELECT DISTINCT id, license, n, words[i:i + 2] AS s FROM (SELECT id, license, words, len(words) AS n, unnest(range(1, len(words) - 1)) AS i FROM template)
), sizes AS (
  SELECT id, count(*) AS total, count(must) AS musts FROM wanted LEFT JOIN telling USING (id, s) GROUP BY id
), shape AS (
  SELECT id, license, n + CAST(ceil(n / 4) AS INT) AS size, greatest(1, n // 4) AS stride, total, musts FROM (SELECT DISTINCT id, license, n FROM wanted) JOIN sizes USING (id)
), doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words FROM documents
), placed AS (
  SELECT doc_id, i - 1 AS p, words[i:i + 2] AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM doc)
), hit AS (
  SELECT doc_id, p, s, id FROM placed JOIN wanted USING (s)
), windowed AS (
  SELECT doc_id, id, s, (p // stride - k) * stride AS start, p, size FROM hit JOIN shape USING (id), range(64) AS r(k) WHERE k <= (size - 3) // stride + 1
), counted AS (
  SELECT doc_id, id, start, count(DISTINCT s) AS n, count(DISTINCT s) FILTER (must) AS told FROM windowed LEFT JOIN telling USING (id, s) WHERE start >= 0 AND p + 3 <= start + size GROUP BY doc_id, id, start
), matched AS (
  SELECT doc_id, license, start, n / total AS containment FROM counted JOIN shape USING (id) WHERE n / total >= 0.8 AND told = musts
)
SELECT doc_id, license, max(containment) AS containment, arg_min(start, (-containment, start))::BIGINT AS start FROM matched GROUP BY doc_id, license
"""


def op5_url_reputation(rules: tuple[tuple[str, str, str], ...], suffixes: tuple[str, ...]) -> str:
    """Rates per host, domain and suffix with the same estimates, as one statement."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v}:{h}{p}'" for v, h, p in ordered)
    listed = ", ".join(f"'{s}'" for s in suffixes)

    def strength(children: str, parent: str) -> str:
        return f"""(
  SELECT (1 - rho) / rho FROM (
    SELECT least(greatest(CASE WHEN scale > 0 THEN excess / scale ELSE 0 END, 0.001::DOUBLE), 0.5::DOUBLE) AS rho FROM (
      SELECT sum(q - bad * m - (k - 1) * m * (1 - m)) AS excess, sum(m * (1 - m) * (n - nn / n - (k - 1))) AS scale FROM (
        SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(bad * bad / n::DOUBLE) AS q, sum(n * n)::DOUBLE AS nn, sum(bad) / sum(n)::DOUBLE AS m
        FROM {children} WHERE n > 0 GROUP BY {parent}))))"""

    def posterior(strength: str, level: str, above: str) -> str:
        """Mean and variance under a prior of two parts, ordinary (strength) and odd (2)."""

        def evidence(size: str) -> str:
            p = "least(greatest(above, 1e-6::DOUBLE), 1 - 1e-6::DOUBLE)"
            prior = f"lgamma({size} * {p}) + lgamma({size} * (1 - {p})) - lgamma({size}::DOUBLE)"
            return f"lgamma({size} * {p} + bad) + lgamma({size} * (1 - {p}) + n - bad) - lgamma({size} + n::DOUBLE) - ({prior})"

        return f"""(
  SELECT *, (1 - odd) * m1 + odd * m2 AS mean,
    (1 - odd) * m1 * (1 - m1) / (size + n + 1) + odd * m2 * (1 - m2) / (2 + n + 1) + odd * (1 - odd) * (m1 - m2) ** 2 AS variance FROM (
    SELECT *, (size * above + bad) / (size + n) AS m1, (2 * above + bad) / (2 + n) AS m2,
      1 / (1 + 99 * exp(least({evidence("size")} - ({evidence("2")}), 700))) AS odd FROM (
      SELECT l.*, {above} AS above, {strength} AS size FROM {level})))"""

    return rf"""
WITH outcome AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality = 1 AND toxic = 0 THEN 0 END) AS bad FROM labels GROUP BY doc_id
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), counted AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(regexp_replace(host, ':\d*$', ''), '.') AS labels
  FROM named LEFT JOIN outcome ON page_id = doc_id GROUP BY host
), host_counts AS (
  SELECT host, n, bad, CASE WHEN two IN ({listed}) THEN array_to_string(labels[-3:], '.') ELSE two END AS domain,
    CASE WHEN two IN ({listed}) THEN two ELSE labels[-1] END AS suffix
  FROM (SELECT *, array_to_string(labels[-2:], '.') AS two FROM counted)
), domain_counts AS (
  SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM host_counts GROUP BY suffix, domain
), suffix_counts AS (
  SELECT suffix, '' AS root, sum(n) AS n, sum(bad) AS bad FROM domain_counts GROUP BY suffix
), overall AS (
  SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n)::DOUBLE ELSE 0 END AS rate, {strength("suffix_counts", "root")} AS s0,
    {strength("domain_counts", "suffix")} AS s1, {strength("host_counts", "domain")} AS s2 FROM suffix_counts
), by_suffix AS (
  SELECT suffix, mean FROM {posterior("s0", "suffix_counts l, overall", "rate")}
), by_domain AS (
  SELECT domain, mean FROM {posterior("s1", "domain_counts l JOIN by_suffix s USING (suffix), overall", "s.mean")}
), by_host AS (
  SELECT host, greatest(mean - 1.645 * sqrt(variance), 0) AS lower FROM {posterior("s2", "host_counts l JOIN by_domain d USING (domain), overall", "d.mean")}
), judged AS (
  SELECT page_id, host, path, CASE {fits} END AS fit, lower > least(3 * rate / (1 + 2 * rate), 0.5) AS bad_host FROM named JOIN by_host USING (host), overall
)
SELECT page_id, host, path, substr(fit, strpos(fit, ':') + 1) AS rule,
  coalesce(split_part(fit, ':', 1), CASE WHEN bad_host THEN 'block' ELSE 'allow' END) AS verdict FROM judged
"""

# Every vector with every other one, and paths of links; the operator's trees have to find the same.
OP11_EMBEDDING_DEDUP = r"""
WITH RECURSIVE fit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM fit a JOIN fit b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
  SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, l.w FROM reached r JOIN links l ON r.w = l.u
), least AS (
  SELECT u, min(w) AS component_id FROM reached GROUP BY u
), counted AS (
  SELECT u, count(*) AS n_links FROM links GROUP BY u
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.u LEFT JOIN counted ON e.vec_id = counted.u
"""

OP12_HARD_NEGATIVES = r"""
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM fit a JOIN fit b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER near AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW near AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER near <= 5
"""
