"""The same views in SQL, as common table expressions for the comparison queries."""

from __future__ import annotations

CTES: dict[str, str] = {
    "docs": "SELECT 'doc_' || doc_id AS paper_id, * FROM documents",
    "chunk_lists": r"""
SELECT doc_id, 'doc_' || doc_id AS paper_id, lang, source,
       list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')) AS ls
FROM documents""",
    "chunks": r"""
SELECT doc_id, paper_id, lang, source, text, total_chunks, i AS chunk_index,
       paper_id || '_chunk_' || printf('%03d', i) AS chunk_id, doc_id * 2147483648 + i AS seq,
       i // 10 + 1 AS page_number, paper_id || '.pdf' AS source_pdf
FROM (SELECT doc_id, paper_id, lang, source, len(ls)::BIGINT AS total_chunks, unnest(ls) AS text,
             (generate_subscripts(ls, 1) - 1)::BIGINT AS i FROM chunk_lists)""",
    "species_base": r"""
SELECT item_id, upper(left(lower(w[1]), 1)) || substr(lower(w[1]), 2) || ' ' || lower(w[2]) AS species
FROM (SELECT item_id, regexp_extract_all(replace(text, 'ß', 'ss'), '[A-Za-zÀ-ÿ]+') AS w FROM benchmark)""",
    "species": r"""
SELECT item_id * 5 + v AS pos, (['plain', 'upper', 'underscore', 'open', 'hybrid'])[v + 1] AS kind,
       CASE v WHEN 0 THEN species WHEN 1 THEN upper(species) WHEN 2 THEN replace(species, ' ', '_')
              WHEN 3 THEN split_part(species, ' ', 1) || ' sp.'
              ELSE split_part(species, ' ', 1) || '/' || split_part(species, ' ', 2) END AS species
FROM species_base, (SELECT unnest([0, 1, 2, 3, 4]) AS v)""",
    "articles": r"""
SELECT pos, item_id, species, lang, title, abstract, year, doi, source, source_prio, keywords, journal,
       list_filter(string_split(title, ' ')[1:2], lambda x: x <> '') AS authors
FROM (
  SELECT doc_id AS pos, item_id, species, lang,
    CASE WHEN doc_id % 3 = 0 THEN species || ': ' || sentence ELSE sentence END AS title,
    nullif(trim(regexp_replace(substr(text, length(regexp_extract(ls[1], '^[^.]*\.?')) + 1), '^\n', '')), '') AS abstract,
    CASE WHEN doc_id % 11 <> 0 THEN (1990 + doc_id % 35)::INTEGER END AS year,
    CASE WHEN doc_id % 5 <> 0 THEN '10.1000/' || doc_id END AS doi,
    (['PubMed', 'CrossRef', 'Scopus', 'ScienceDirect', 'ArXiv', 'PLOS'])[num % 6 + 1] AS source,
    (num % 6)::BIGINT AS source_prio,
    CASE WHEN doc_id % 3 = 1 THEN [lang, source] END AS keywords,
    'Journal ' || source AS journal
  FROM (SELECT *, string_split(text, chr(10)) AS ls,
               trim(regexp_extract(string_split(text, chr(10))[1], '^[^.]*')) AS sentence,
               regexp_extract(source, '[0-9]+')::INTEGER AS num,
               doc_id % (SELECT count(*) FROM benchmark) AS item_id FROM documents)
  JOIN species_base USING (item_id)
)""",
    "turns": "SELECT conv_id AS paper_id, turn + 1 AS page_number, text FROM conversations",
    "framed_turns": """
SELECT paper_id, page_number, 'Journal ' || (paper_id % 3) || chr(10) || text || chr(10) || 'Page footer ' || paper_id AS text
FROM turns""",
    "vectors": "SELECT vec_id AS seq, 'v' || vec_id AS chunk_id, 'paper_' || label AS paper_id, embedding FROM embeddings",
    "questions": "SELECT item_id AS query_id, text AS question FROM benchmark",
    "question_vectors": """
SELECT item_id AS query_id, text AS question, embedding FROM benchmark JOIN embeddings ON vec_id = item_id % (SELECT count(*) FROM embeddings)""",
    "hybrid_chunks": """
SELECT c.*, embedding FROM chunks c JOIN embeddings ON vec_id = seq % (SELECT count(*) FROM embeddings)""",
    "habitats": """
SELECT s_name AS species, s_nationkey % 2 = 0 AS marine, s_nationkey % 3 = 0 AS freshwater,
       s_nationkey % 5 = 0 AS terrestrial FROM supplier""",
    "marine_registry": "SELECT s_name AS species FROM supplier WHERE s_acctbal > 5000",
    "statuses": """
SELECT o_orderkey AS article, 'species_' || o_custkey AS species,
       CASE o_orderstatus WHEN 'F' THEN 'downloaded' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status FROM orders""",
    "attempts": """
SELECT doc_id, prio, 'extractor_' || prio AS provider, n_chars * prio // 3 AS chars, 1 + (n_chars * prio // 3) // 2000 AS pages
FROM documents, (SELECT unnest([1, 2, 3])::BIGINT AS prio)""",
    "entities": """
SELECT 'region::' || r_regionkey AS entity_id, 'Location' AS entity_type, r_name AS name, [upper(r_name), 'Location ' || r_regionkey] AS aliases FROM region
UNION ALL SELECT 'nation::' || n_nationkey, 'Location', n_name, [upper(n_name), 'Location ' || n_nationkey] FROM nation
UNION ALL SELECT 'author::' || c_custkey, 'Author', c_name, [upper(c_name), 'Author ' || c_custkey] FROM customer
UNION ALL SELECT 'method::' || s_suppkey, 'Method', s_name, [upper(s_name), 'Method ' || s_suppkey] FROM supplier
UNION ALL SELECT 'species::' || p_partkey, 'Species', p_name, [upper(p_name), 'Species ' || p_partkey] FROM part""",
    "relations": """
SELECT *, subject_id || '::' || relation_type || '::' || object_id AS relation_id FROM (
SELECT 'author::' || c_custkey AS subject_id, 'found_in' AS relation_type, 'nation::' || c_nationkey AS object_id, (c_custkey % 100) / 100.0 AS confidence FROM customer
UNION ALL SELECT 'nation::' || n_nationkey, 'co_occurs_with', 'region::' || n_regionkey, (n_nationkey % 100) / 100.0 FROM nation
UNION ALL SELECT 'method::' || s_suppkey, 'studies', 'nation::' || s_nationkey, (s_suppkey % 100) / 100.0 FROM supplier
UNION ALL SELECT 'method::' || s_suppkey, 'measured_by', 'nation::' || s_nationkey, (s_suppkey % 100) / 100.0 FROM supplier
UNION ALL SELECT 'method::' || l_suppkey, 'interacts_with', 'species::' || l_partkey, (l_suppkey % 100) / 100.0
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))""",
    "order_papers": "SELECT o_orderkey, o_custkey, 'paper_' || (o_orderkey % 50) AS paper_id FROM orders",
    "mentions": """
SELECT 'author::' || o_custkey AS entity_id, paper_id FROM order_papers
UNION SELECT 'species::' || l_partkey, paper_id FROM lineitem JOIN order_papers ON l_orderkey = o_orderkey
UNION SELECT 'method::' || l_suppkey, paper_id FROM lineitem JOIN order_papers ON l_orderkey = o_orderkey""",
    # the parsed content of the raw answers: broken ones (every 17th) hold nothing
    "order_parts": """
SELECT l_orderkey, l_partkey, o_custkey, max(l_discount) AS disc, any_value(p_name) AS p_name, any_value(p_type) AS p_type,
       'chunk_' || l_orderkey AS chunk_id, 'paper_' || (l_orderkey % 50) AS paper_id
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE l_orderkey % 17 <> 0 GROUP BY ALL""",
    "raw_entities": """
SELECT DISTINCT chunk_id, paper_id, l_orderkey AS ord, 0 AS pos, 'Customer ' || o_custkey AS name, 'Author' AS type,
       'C' || o_custkey AS alias, 'customer' AS kind, 'author::customer_' || o_custkey AS entity_id FROM order_parts
UNION ALL
SELECT chunk_id, paper_id, l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey), p_name || ' ' || l_partkey,
       'Species', 'P' || l_partkey, p_type, 'species::' || replace(lower(p_name), ' ', '_') || '_' || l_partkey
FROM order_parts WHERE l_partkey % 7 <> 0""",
    "raw_relations": """
SELECT chunk_id, paper_id, l_orderkey AS ord, l_partkey AS pos, 'author::customer_' || o_custkey AS subject_id, 'studies' AS relation_type,
       'species::' || replace(lower(p_name), ' ', '_') || '_' || l_partkey AS object_id,
       least(1.0, round(disc * 100) / 5) AS confidence, 'line ' || l_partkey AS snippet,
       'author::customer_' || o_custkey || '::studies::species::' || replace(lower(p_name), ' ', '_') || '_' || l_partkey AS relation_id
FROM order_parts WHERE l_partkey % 7 <> 0 AND l_partkey % 5 <> 0""",
    "growth": """
SELECT l_partkey AS SpecCode, max(l_discount) AS K,
       CASE WHEN l_linenumber = 7 THEN -999.0 ELSE max(l_extendedprice) / 1000 END AS Loo, -max(l_tax) AS t_o,
       CASE WHEN max(l_quantity) % 7 <> 0 THEN max(l_quantity)::BIGINT END AS N,
       CASE max(l_returnflag) WHEN 'A' THEN 'male' WHEN 'N' THEN 'combined' WHEN 'R' THEN 'female' END AS sex,
       n_name AS locality, l_orderkey, l_linenumber, n_name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY l_orderkey, l_partkey, l_linenumber, n_name""",
    "length_weight": """
SELECT l_partkey AS SpecCode, max(l_tax) AS a, 2.5 + max(l_discount) AS b, max(l_quantity)::BIGINT AS N, l_orderkey, l_linenumber
FROM lineitem GROUP BY l_orderkey, l_partkey, l_linenumber""",
    "parameters": """
SELECT SpecCode, 'growth' AS src, 'K' AS parameter, K AS value, 'yr⁻¹' AS unit, NULL AS method, locality, upper(n_name) AS country, sex, N AS n_samples, l_orderkey AS data_ref, l_orderkey, l_linenumber, n_name FROM growth
UNION ALL SELECT SpecCode, 'growth', 'Linf', Loo, 'cm', NULL, locality, upper(n_name), sex, N, l_orderkey, l_orderkey, l_linenumber, n_name FROM growth WHERE Loo <> -999
UNION ALL SELECT SpecCode, 'growth', 't0', t_o, 'yr', NULL, locality, upper(n_name), sex, N, l_orderkey, l_orderkey, l_linenumber, n_name FROM growth
UNION ALL SELECT SpecCode, 'length_weight', 'a', a, 'g·cm⁻ᵇ', 'Length type: TL', NULL, NULL, 'combined', N, NULL, l_orderkey, l_linenumber, '' FROM length_weight
UNION ALL SELECT SpecCode, 'length_weight', 'b', b, 'dimensionless', 'Length type: TL', NULL, NULL, 'combined', N, NULL, l_orderkey, l_linenumber, '' FROM length_weight
UNION ALL SELECT p_partkey, 'ecology', 'TrophicLevel', 2 + p_size / 25, 'dimensionless', 'FishBase ecology table', NULL, NULL, NULL, NULL, p_size, p_partkey, 0, '' FROM part WHERE p_size % 4 <> 0
UNION ALL SELECT p_partkey, 'maturity', 'Lmat', p_size * 1.5, 'cm', p_type, p_brand, p_type, 'male', p_size, p_partkey % 97, p_partkey, 0, '' FROM part WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey, 'maturity', 'Amat', p_size / 10, 'yr', p_type, p_brand, p_type, 'male', p_size, p_partkey % 97, p_partkey, 0, '' FROM part WHERE p_size % 3 = 0 AND p_size % 2 <> 0
UNION ALL SELECT p_partkey, 'qb', 'QB', p_retailprice / 100, 'yr⁻¹', p_brand, p_type, NULL, NULL, NULL, NULL, p_partkey, 0, '' FROM part WHERE p_partkey % 5 = 0""",
    "spec_names": """
SELECT p_partkey AS SpecCode, upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) AS Genus,
       split_part(p_name, ' ', 2) || (p_partkey % 50) AS Species FROM part""",
    "tokens": """
SELECT chunk_id, seq, unnest(regexp_extract_all(lower(text), '[a-zA-Záéíóúñüà-ÿ0-9]+')) AS term FROM chunks""",
    "doc_len": "SELECT chunk_id, any_value(seq) AS seq, count(*) AS dl FROM tokens GROUP BY chunk_id",
    "postings": "SELECT chunk_id, term, count(*) AS tf FROM tokens GROUP BY chunk_id, term",
    "corpus": "SELECT count(*) AS n, sum(len(regexp_extract_all(lower(text), '[a-zA-Záéíóúñüà-ÿ0-9]+'))) / count(*) AS avgdl FROM chunks",
    "term_df": "SELECT term, count(*) AS df FROM postings GROUP BY term",
    "term_raw": "SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM term_df, corpus",
    "term_stats": """
SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM term_raw) ELSE raw END AS idf FROM term_raw""",
    "query_terms": """
SELECT query_id, term, count(*) AS qtf FROM (
  SELECT query_id, unnest(regexp_extract_all(lower(question), '[a-zA-Záéíóúñüà-ÿ0-9]+')) AS term FROM questions) GROUP BY ALL""",
    "bm25_scores": """
SELECT query_id, p.chunk_id, any_value(d.seq) AS seq,
       round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
FROM query_terms JOIN postings p USING (term) JOIN term_stats USING (term) JOIN doc_len d ON d.chunk_id = p.chunk_id, corpus
GROUP BY query_id, p.chunk_id""",
    "bm25_ranked": """
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seq) AS rank FROM bm25_scores""",
}

NEEDS: dict[str, list[str]] = {
    "chunks": ["chunk_lists"], "species": ["species_base"], "articles": ["species_base"],
    "framed_turns": ["turns"], "hybrid_chunks": ["chunks"], "mentions": ["order_papers"],
    "raw_entities": ["order_parts"], "raw_relations": ["order_parts"], "parameters": ["growth", "length_weight"],
    "tokens": ["chunks"], "doc_len": ["tokens"], "postings": ["tokens"], "corpus": ["chunks"],
    "term_df": ["postings"], "term_raw": ["term_df", "corpus"], "term_stats": ["term_raw"],
    "query_terms": ["questions"],
    "bm25_scores": ["query_terms", "postings", "term_stats", "doc_len", "corpus"],
    "bm25_ranked": ["bm25_scores"],
}


def bm25(prefix: str, source: str, queries: str = "questions") -> dict[str, str]:
    """Keyword ranking over another chunk expression: ``{prefix}_ranked``."""
    p = prefix
    return {
        f"{p}_tok": f"SELECT seq, chunk_id, regexp_extract_all(lower(text), '[a-zA-Záéíóúñüà-ÿ0-9]+') AS toks FROM {source}",
        f"{p}_corpus": f"SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {p}_tok",
        f"{p}_post": f"SELECT seq, chunk_id, dl, term, count(*) AS tf FROM (SELECT seq, chunk_id, len(toks) AS dl, unnest(toks) AS term FROM {p}_tok) GROUP BY ALL",
        f"{p}_raw": f"SELECT term, ln(any_value(n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM {p}_post, {p}_corpus GROUP BY term",
        f"{p}_idf": f"SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM {p}_raw) ELSE raw END AS idf FROM {p}_raw",
        f"{p}_qt": f"SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest(regexp_extract_all(lower(question), '[a-zA-Záéíóúñüà-ÿ0-9]+')) AS term FROM {queries}) GROUP BY ALL",
        f"{p}_scores": f"""SELECT query_id, chunk_id, seq, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
            FROM {p}_qt JOIN {p}_post USING (term) JOIN {p}_idf USING (term), {p}_corpus GROUP BY query_id, chunk_id, seq""",
        f"{p}_ranked": f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seq) AS rank FROM {p}_scores",
    }


def vector(prefix: str, source: str, queries: str = "question_vectors") -> dict[str, str]:
    """Vector ranking over a chunk expression: ``{prefix}_ranked``."""
    return {
        f"{prefix}_ranked": f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seq) AS rank FROM (
            SELECT query_id, chunk_id, seq, round((list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) + 1) / 2, 9) AS score FROM {queries} q, {source} v)""",
    }


def fx(names: str, body: str, **extra: str) -> str:
    """``body`` behind the named expressions (and what they need) plus further ones."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
