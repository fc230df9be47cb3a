"""The registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm import (
    alignment, decontaminate, filter_audit, html_text, license_scan, ngram_join, packing, personal_data, sharding, topk, toxicity, url_filter, warc)
from martspark.llm.common import table

URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
#: Host names with these words are blocked seeds.
BLOCKED_HOSTS = r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases, and labels of phrases and of notices found despite edits."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start_word").alias("first_word"), F.array_max("phrases.start_word").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "notices.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("phrases.similarity", "notices.similarity")), F.lit(0.0)).alias("score"),
        F.size("notices").cast("long").alias("n_notices"),
    )


#: Most bytes of text in a shard.
SHARD_BYTES = 1 << 20


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard by extendible hashing."""
    return sharding.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens along the Hilbert curve."""
    return packing.pieces(table(spark, sf_dir, "documents"), packing.tokenizer_path())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected severity by the ordinal model fitted on labelled documents."""
    return toxicity.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, then by its host's trust and distrust."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, blocked=BLOCKED_HOSTS)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component by five-word shingles and a similarity of 0.75."""
    return ngram_join.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best answers to every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside 10-word windows of the benchmark, and the items it comes near to (n_near)."""
    return decontaminate.digest(decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"), least_bytes=100).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    return personal_data.digest(personal_data.find(table(spark, sf_dir, "documents")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, and how common its linked pairs of ids are."""
    return alignment.summary(table(spark, sf_dir, "documents"), packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in every order, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_ngram_join": op6_ngram_join,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_decontamination": op8_decontamination,
    "op9_html_extraction": op9_html_extraction,
    "op10_warc": op10_warc,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x20\\x09-\\x0D]+')"



def _spans(kind: str, rank: int, rule: str, group: int, valid: str) -> str:
    """Rows (r, rank, kind, s, e) of a rule's matches: places follow from the lengths of what lies between them."""
    rule = rule.replace("'", "''")
    return f"""select r, {rank} o, '{kind}' kind, e - length(v) s, e from (
        select r, v[i] v, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(w[1:i], lambda x: length(x))))::bigint e
        from (select r, string_split_regex(t, '{rule}') gaps, regexp_extract_all(t, '{rule}') w, regexp_extract_all(t, '{rule}', {group}) v
              from d where regexp_matches(t, '{rule}')), unnest(range(1, len(w) + 1)) u(i)) where {valid}"""


_D = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""case when length({_D}) between 13 and 19 then list_sum([case when i % 2 = 1 then substr({_D}, length({_D}) - i + 1, 1)::int
    else 2 * substr({_D}, length({_D}) - i + 1, 1)::int - case when substr({_D}, length({_D}) - i + 1, 1)::int > 4 then 9 else 0 end end
    for i in range(1, length({_D}) + 1)]) % 10 = 0 else false end"""
_I = "replace(v, ' ', '')"
_MOD97 = f"""length({_I}) between 15 and 34 and list_reduce(list_transform(string_split(array_to_string(list_transform(
    string_split(substr({_I}, 5) || substr({_I}, 1, 4), ''), lambda c: case when c between '0' and '9' then c else (ascii(c) - 55)::varchar end), ''), ''),
    lambda c: c::int), lambda a, c: (10 * a + c) % 97) = 1"""
#: Kind: rule, the span's group in it, test of the span v.
_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0, "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 0, r"regexp_full_match('.' || v, '(\.0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]))+')"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", 0, _LUHN),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0, f"length({_D}) between 9 and 15"),
    "login": (r"://()([A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!$&*+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)", 2, "true"),
    "iban": (r"(?i:iban)([ :=#]{0,3})([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)", 2, _MOD97),
    "account": (r"(?i:account|acct|konto|cuenta|compte)((?: (?:no|nr|number|id)\.?)?[ :=#]{0,3})([0-9](?:[ -]?[0-9])+)", 2, f"length({_D}) between 6 and 18"),
    "ssn": (r"(?i:ssn|social security number)([ :=#]{0,3})([0-9]{3}-[0-9]{2}-[0-9]{4})", 2,
            "left(v, 3) not in ('000', '666') and left(v, 3) < '900' and substr(v, 5, 2) <> '00' and right(v, 4) <> '0000'"),
    "secret": (r"(?i:token|secret|password|passwd|api_key|apikey)(\"? ?[:=] ?[\"']?)([A-Za-z0-9_/+.-]{12,})", 2, "true"),
}

#: op1 (edits), op3 (cuts are free), op4 (a fitted model), op5 (iterated scores), op9 (a tree), op12 (tokenizers) and the pipeline have no SQL; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    # Buckets of every depth from the leading bits of the id's hash; a document lies in the shallowest that fits.
    "op2_sharding": f"""
        with d as (select doc_id, coalesce(strlen(text), 0)::bigint bytes,
                lpad(bin(('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 4))::ubigint), 16, '0') cell from documents),
        p as (select doc_id, bytes, depth, substr(cell, 1, depth) shard from d, range(0, 17) t(depth)),
        b as (select depth, shard, sum(bytes)::bigint shard_bytes, count(*) shard_docs from p group by all
              having sum(bytes) <= {SHARD_BYTES} or count(*) = 1)
        select doc_id, bytes, shard, depth::int depth, shard_bytes, shard_docs from p join b using (depth, shard)
        qualify row_number() over (partition by doc_id order by depth) = 1""",
    # All pairs that share a shingle, then the closure of the links.
    "op6_ngram_join": f"""
        with recursive w as (select doc_id, {_SPACED} w from documents),
        s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i+4], ' ') end g
              from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0),
        n as (select doc_id, count(*) n from s group by 1),
        k as (select a.doc_id a, b.doc_id b, count(*) k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
        l as (select a, b from k join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
        r as (select doc_id, doc_id to_id from documents union select r.doc_id, l.b from r join l on l.a = r.to_id)
        select doc_id, coalesce(n, 0)::bigint n_shingles, min(to_id) component_id from r left join n using (doc_id) group by 1, 2""",
    "op8_decontamination": f"""
        with d as (select row_number() over () r, doc_id, {_ALNUM} w from documents),
        i as (select item_id, {_ALNUM} w from benchmark where item_id is not null),
        win as (select distinct item_id, least(10, len(w)) n, array_to_string(w[j:j+least(10, len(w))-1], ' ') g
                from i, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(j) where len(w) > 0),
        occ as (select r, j, n, array_to_string(w[j:j+n-1], ' ') g from d, (select distinct n from win), unnest(range(1, len(w) - n + 2)) t(j)),
        hit as (select r, j, n, item_id from occ join win using (n, g)),
        pos as (select r, count(distinct p) n_hit from (select r, unnest(range(j, j + n)) p from hit) group by 1),
        ids as (select r, string_agg(id, ',' order by id) ids, count(*) n_items from (select distinct r, item_id::varchar id from hit) group by 1),
        -- Proximity: the two rarest terms of a window, within five words of their distance.
        it as (select row_number() over () k, item_id, w from (select distinct item_id, w from i where len(w) > 0)),
        tm as (select k, j q, lower(w[j]) term, least(10, len(w)) size, len(w) - least(10, len(w)) + 1 last_start from it, unnest(range(1, len(w) + 1)) t(j)),
        dp as (select r, lower(w[j]) term, j p from d, unnest(range(1, len(w) + 1)) t(j) where lower(w[j]) in (select term from tm)),
        tn as (select term, count(*) n from dp group by 1),
        wi as (select k, s, size, n, term, q from tm join tn using (term), unnest(range(greatest(1, q - size + 1), least(q, last_start) + 1)) u(s)),
        an as (select distinct k, a[1].term t1, a[1].q q1, a[2].term t2, a[2].q q2
               from (select k, s, list({{'n': n, 'term': term, 'q': q}} order by n, term, q) a from wi group by k, s, size having count(*) = size)),
        nr as (select r, count(distinct item_id) n_near from (
                 select x.r, k from an join dp x on x.term = t1 join dp y on y.term = t2 and y.r = x.r and abs((y.p - q2) - (x.p - q1)) <= 5
                 union all select x.r, k from an join dp x on x.term = t1 where t2 is null) join it using (k) group by 1)
        select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
            sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated, coalesce(n_near, 0)::bigint n_near
        from d left join pos using (r) left join ids using (r) left join nr using (r)""",
    "op7_exact_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) t from embeddings
                   where embedding is not null and vec_id is not null
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        e as (select vec_id, unnest(t) w, generate_subscripts(t, 1) i from v),
        s as (select q.vec_id query_id, c.vec_id, sum(q.w * c.w)::bigint score from e q join e c on q.i = c.i and q.vec_id <> c.vec_id
              where q.vec_id % 100 = 0 group by 1, 2)
        select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int "rank", vec_id, score from s
        qualify "rank" <= 10""",
    "op10_warc": """
        with p as (select page_id, coalesce(html, '') h, strlen(coalesce(html, ''))::bigint payload_bytes from pages),
        d as (select page_id, payload_bytes, sha256(h) payload_digest, min(page_id) over (partition by h) first_id from p)
        select page_id, payload_bytes, payload_digest,
            case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end record_type,
            case when payload_bytes >= 100 and page_id > first_id then first_id end refers_to from d""",
    # Leftmost matches of each kind's rule over the whole text; anchors play no part.
    "op11_pii": f"""
        with d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
        p as ({" union all ".join(_spans(k, o, *x) for o, (k, x) in enumerate(_PII.items()))}),
        g as (select r, count(*) filter (kind = 'email') n_email, count(*) filter (kind = 'ip') n_ip, count(*) filter (kind = 'card') n_card,
                count(*) filter (kind = 'phone') n_phone, string_agg(kind || ':' || s || ':' || e, ',' order by o, s) filter (o < 4) base,
                string_agg(kind || ':' || s || ':' || e, ',' order by o, s) spans from p group by r)
        select doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card, coalesce(n_phone, 0) n_phone,
            sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from d left join g using (r)""",
    # Every document is followed through every order.
    "op13_filter_audit": """
        with d as (select row_number() over () r, doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents),
        w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') w, min(doc_id) over (partition by t) first_id from d),
        l as (select doc_id, max((quality = 1)::int) good, max((toxic = 1)::int) toxic from labels group by 1),
        f as (select r, part, coalesce(good, 0) good, coalesce(toxic, 0) toxic, concat(case when len(w) < 100 then 'A' end,
                case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' end,
                case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' end,
                case when regexp_matches(t, '[#$%&*|]') then 'D' end, case when doc_id > first_id then 'E' end) fails
              from w left join l using (doc_id)),
        m as (select part, fails, count(*) n, sum(good) good, sum(toxic) toxic from f group by all),
        x(c) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
        o as (select a.c || b.c || c.c || d.c || e.c o from x a, x b, x c, x d, x e
              where length(regexp_replace('ABCDE', '[' || a.c || b.c || c.c || d.c || e.c || ']', '', 'g')) = 0),
        s as (select o, i::int step, substr(o, i, 1) c, '[_' || substr(o, 1, i - 1) || ']' earlier from o, range(1, 6) t(i)),
        y as (select part, o, step, c, sum(case when not regexp_matches(fails, earlier) and not contains(fails, c) then n else 0 end) kept,
                sum(case when not regexp_matches(fails, earlier) and contains(fails, c) then n else 0 end) removed,
                sum(case when regexp_matches(fails, earlier) and contains(fails, c) then n else 0 end) redundant,
                sum(case when fails = c then n else 0 end) unique_fails,
                sum(case when not regexp_matches(fails, earlier) and contains(fails, c) then good else 0 end) good_lost,
                sum(case when not regexp_matches(fails, earlier) and contains(fails, c) then toxic else 0 end) toxic_lost
              from m, s group by all)
        select part, o filter_order, step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant, unique_fails::bigint unique_fails,
            good_lost::bigint good_lost, toxic_lost::bigint toxic_lost, (sum(removed) over (partition by part, c))::bigint shapley from y""",
}
