"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import licenses, mixing, urls

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _mix_sql() -> str:
    n = len(mixing.WEIGHTS)
    weight = f"[{', '.join(map(str, mixing.WEIGHTS))}][(rank - 1) % {n} + 1]"
    e0 = f"[{', '.join(f'{r[0]}::double' for r in mixing.RAMPS)}][(rank - 1) % {n} + 1]"
    e1 = f"[{', '.join(f'{r[1]}::double' for r in mixing.RAMPS)}][(rank - 1) % {n} + 1]"
    takes = [f"greatest(0, least(size, demand - (start + {p} * source_size)))" for p in range(3)]
    return f"""
    with rows as (
      select doc_id, source, len({WORDS})::bigint size, md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')) key from documents),
    sizes as (select source, sum(size)::bigint source_size, count(*) source_rows from rows group by source),
    ranked as (
      select *, {weight} weight, {e0} e0, {e1} e1, 3 * source_size as "full" from (
        select *, row_number() over (order by source nulls last) rank from sizes)),
    levels as (
      select *, (sum(source_size) over () - coalesce(sum("full") over w, 0))::double
        / (sum(weight) over () - coalesce(sum(weight) over w, 0))::double as "level"
      from ranked window w as (order by "full"::double / weight, rank rows between unbounded preceding and 1 preceding)),
    targets as (
      select source, source_size, source_rows, e0, e1,
        least("full"::double, max("level") over () * weight) target from levels),
    starts as (
      select r.doc_id, r.size, t.source_size, t.target, t.e0, t.e1, round(t.target)::bigint demand,
        coalesce(sum(r.size) over (partition by r.source order by r.key, r.size
          rows between unbounded preceding and 1 preceding), 0)::bigint start
      from rows r join targets t on r.source is not distinct from t.source),
    takes as (
      select *, {' + '.join(takes)} taken,
        case when {takes[0]} > 0 then start / greatest(demand, 1)
          when {takes[1]} > 0 then (start + source_size) / greatest(demand, 1)
          when {takes[2]} > 0 then (start + 2 * source_size) / greatest(demand, 1) end as "share"
      from starts)
    select doc_id, size, source_size, target, taken::bigint taken,
      2 * "share" / (e0 + sqrt(greatest(0.0, e0 * e0 + 2 * (e1 - e0) * "share"))) as position
    from takes"""


#: Votes written out: (rule, amount, out of, bad from, good up to).
VOTES = [
    ("a", "n_symbols", "n_words", "0.2", "0.01"), ("b", "n_symbols", "n_words", "0.1", "0.02"),
    ("c", "n_symbols", "word_chars", "0.03", "0.005"), ("d", "n_symbols", "n_marks", "0.5", "0.1"),
    ("e", "n_shouts", "n_words", "0.2", "0.02"), ("f", "n_upper", "n_words", "0.3", "0.02"),
    ("g", "n_repeat_words", "n_words", "0.5", "0.1"), ("h", "n_repeat_words", "n_words", "0.3", "0.05"),
    ("i", "word_chars", "n_words", "7", "6"), ("j", "n_marks", "n_words", "0.3", "0.2"),
    ("k", "n_open", "least(n_words, 1)", "1", "0"),
]


def _rules_sql(rounds: int = 25) -> str:
    names = [f"v_{v[0]}" for v in VOTES]
    votes = ", ".join(
        f"(case when {y} = 0 then 0 when {x} >= {bad}::double * {y} then -1 when {x} <= {good}::double * {y} then 1 else 0 end) v_{n}"
        for n, x, y, bad, good in VOTES
    )
    start = f"0.5::double + 0.45::double * ({' + '.join(names)}) / {len(names)}"
    blanks = r"'[\x20\x09-\x0D]'"
    ctes = [f"""
    base as (
      select doc_id, coalesce(text, '') t, {WORDS} w from documents),
    tri as (
      select doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] x
      from (select doc_id, w, unnest(range(1, len(w) - 1)) i from base)),
    twice as (select doc_id, i from tri qualify count(*) over (partition by doc_id, x) > 1),
    repeats as (
      select doc_id, count(distinct i + j) n from twice, (select unnest([0, 1, 2]) j) group by doc_id),
    stats as (
      select b.doc_id, len(w)::bigint n_words,
        length(regexp_replace(t, {blanks}, '', 'g'))::bigint word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint n_symbols,
        (len(l) - len(list_distinct(l)))::bigint n_dup_lines,
        coalesce(r.n, 0)::bigint n_repeat_words, len(l)::bigint n_lines,
        (length(t) - length(translate(t, '!', '')))::bigint n_shouts,
        len(list_filter(w, lambda x: upper(x) = x and lower(x) <> x and length(x) > 1))::bigint n_upper,
        (length(t) - length(translate(t, '.,;:?!', '')))::bigint n_marks,
        (len(w) > 0 and not regexp_matches(w[-1], '[.!?]['')"]*\\z'))::bigint n_open
      from (select *, list_filter(string_split(t, chr(10)),
              lambda x: length(regexp_replace(x, {blanks}, '', 'g')) > 0) l from base) b
        left join repeats r using (doc_id)),
    votes as (select *, {votes} from stats),
    patterns as (select {', '.join(names)}, count(*) n from votes group by all),
    q0 as (select *, {start} q from patterns)"""]
    for k in range(rounds):
        tallies = ["sum(n * q) good", "sum(n * (1 - q)) bad"]
        logit = ["ln((good + 1) / (bad + 1))"]
        for name in names:
            cases = []
            for v, bound in ((-1, "least"), (1, "greatest")):
                g, b = f"{name}_{v + 1}_good", f"{name}_{v + 1}_bad"
                tallies.append(f"sum(case when {name} = {v} then n * q else 0 end) {g}")
                tallies.append(f"sum(case when {name} = {v} then n * (1 - q) else 0 end) {b}")
                cases.append(f"when {name} = {v} then {bound}(0, ln((({g} + 1) / (good + 3)) / (({b} + 1) / (bad + 3))))")
            logit.append(f"case {' '.join(cases)} else 0 end")
        keys = ", ".join(names)
        ctes.append(f"m{k} as materialized (select {', '.join(tallies)} from q{k})")
        ctes.append(
            f"q{k + 1} as materialized (select {keys}, n, 1 / (1 + exp(-({' + '.join(logit)}))) q from q{k}, m{k})"
        )
    failed = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"
    return f"""with {', '.join(ctes)}
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      {failed} base_failed, not {failed} and q >= 0.5 kept
    from votes join q{rounds} using ({', '.join(names)})"""


def _license_sql() -> str:
    """Every window of every class against every template, without any retrieval step."""
    toks = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{{L}}\p{{N}}]+')"
    listed = ", ".join(f"('{n}', '{t}')" for n, t in licenses.TEMPLATES.items())
    grams = "list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])"
    return f"""
    with templates as (
      select *, greatest(4, pow(2, ceil(log2(len(g))))::int) c from (
        select license, list_distinct({grams}) g from (
          select license, {toks.format('x')} t from (values {listed}) v(license, x)))),
    docs as (
      select doc_id, {grams} g from (select doc_id, {toks.format("coalesce(text, '')")} t from documents)),
    windows as (
      select doc_id, c, s, g[s + 1 : s + 2 * c] g from (
        select doc_id, g, c, unnest(range(0, len(g), c)) s from docs, (select distinct c from templates))),
    shares as (
      select doc_id, license, s, len(list_intersect(list_distinct(w.g), t.g)) / len(t.g) "share"
      from windows w join templates t using (c) where list_has_any(w.g, t.g))
    select doc_id, license, max("share") containment, min(s)::bigint first_word, count(*) n_windows
    from shares where "share" >= 0.8 group by doc_id, license"""


def _urls_sql(rounds: int = 250) -> str:
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link, owner = urls.LINK.replace("'", "''").replace("(?i)", ""), urls.OWNER.replace(r"©", "©")
    ctes = [f"""
    rules as (select * from (values {listed}) v(h, p, v)),
    cut as (
      select page_id, html, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end r from pages),
    split as (
      select page_id, html, {fold.format("regexp_extract(r, '^[^/?#]*')")} host,
        regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') path from cut),
    ruled as (
      select page_id, host, path, h || p rule, v from split left join rules
        on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
      qualify row_number() over (partition by page_id order by length(h || p) desc) = 1),
    links as (
      select host src, {fold.format('dst')} dst from (
        select host, unnest(list_distinct(list_concat(
          regexp_extract_all(html, '{link}', 1, 'i'), regexp_extract_all(html, '{owner}', 1)))) dst from split)),
    edges as (select src, dst, count(*) n from links where src <> dst and src <> '' group by all),
    flow as (
      select src host, 0 kind, dst "to", n / sum(n) over (partition by src) "share" from edges
      union all select dst, 1, src, n / sum(n) over (partition by dst) from edges),
    shares as (
      select host, avg((coalesce(v, '') = 'allow')::int) a, avg((coalesce(v, '') = 'block')::int) b from ruled group by host),
    seeds as (
      select host, 0 kind, a score from shares where a > 0 union all select host, 1, b from shares where b > 0),
    moved as (
      select 0 k, host, kind, score from seeds
      union all
      select k + 1, "to", kind, sum(0.85 * score * "share") from moved join flow using (host, kind)
      where k < {rounds} group by k, "to", kind)"""]
    return f"""with recursive {', '.join(ctes)},
    hosts as (
      select host, sum(case kind when 1 then score else -score end) excess from moved group by host)
    select page_id, host, path, rule,
      coalesce(v, case when coalesce(excess, 0) >= 0.5 then 'block' else 'allow' end) verdict
    from ruled left join hosts using (host)"""


#: Every pair of a label; components by repeated smallest neighbour along a recursive walk.
VECTOR_SQL = """
    with recursive good as (
      select vec_id, label, embedding::double[] v from embeddings
      where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as materialized (
      select a.vec_id a, b.vec_id b from good a join good b using (label)
      where a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98),
    walk as (
      select vec_id id, vec_id reached from good union select walk.id, links.b from walk join links on links.a = walk.reached),
    least as (select id, min(reached) component_id from walk group by id),
    counts as (select a, count(*) n from links group by a)
    select e.vec_id, coalesce(n, 0)::bigint n_links, coalesce(component_id, e.vec_id) component_id,
      e.vec_id = coalesce(component_id, e.vec_id) kept
    from embeddings e left join least on id = e.vec_id left join counts on a = e.vec_id"""


#: Every order is run: a document leaves at the first step whose filter it fails.
AUDIT_SQL = rf"""
    with base as (
      select doc_id, coalesce(lang, '') part, coalesce(text, '') t, {WORDS} w from documents),
    firsts as (select t, min(doc_id) least_id from base group by t),
    marks as (
      select doc_id, coalesce(bool_or(quality = 1), false) good, coalesce(bool_or(toxic = 1), false) toxic
      from labels group by doc_id),
    judged as (
      select part, coalesce(good, false) good, coalesce(toxic, false) toxic,
        case when len(w) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
        || case when 100 * length(regexp_replace(b.t, '[^A-Z]', '', 'g')) > 3 * length(b.t) then 'C' else '' end
        || case when regexp_matches(b.t, '[#$%&*|]') then 'D' else '' end
        || case when least_id < b.doc_id or (b.doc_id is null and least_id is not null) then 'E' else '' end fails
      from base b join firsts f on f.t = b.t left join marks m on m.doc_id = b.doc_id),
    kinds as (select part, fails, good, toxic, count(*) n from judged group by all),
    letters as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
    orders as (
      select a.x || b.x || c.x || d.x || e.x filter_order
      from letters a, letters b, letters c, letters d, letters e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps as (
      select filter_order, step, substr(filter_order, step, 1) x, substr(filter_order, 1, step - 1) earlier
      from orders, (select unnest([1, 2, 3, 4, 5]) step)),
    seen as (
      select s.*, k.*, contains(fails, x) failing, translate(fails, earlier, '') = fails here from steps s, kinds k),
    sums as (
      select part, filter_order, step, x,
        coalesce(sum(n) filter (here and not failing), 0)::bigint kept,
        coalesce(sum(n) filter (here and failing), 0)::bigint removed,
        coalesce(sum(n) filter (failing and not here), 0)::bigint redundant,
        coalesce(sum(n) filter (fails = x), 0)::bigint unique_fails,
        coalesce(sum(n) filter (here and failing and good), 0)::bigint good_lost,
        coalesce(sum(n) filter (here and failing and toxic), 0)::bigint toxic_lost
      from seen group by all)
    select * exclude (x), (sum(removed) over (partition by part, x))::bigint shapley from sums"""


ORACLES: dict[str, str] = {
    "op11_filter_interaction": AUDIT_SQL,
    "op4_curriculum_mix": _mix_sql(),
    "op6_weak_supervision": _rules_sql(),
    "op5_license_scan": _license_sql(),
    "op3_link_trust": _urls_sql(),
    "op10_vector_cells": VECTOR_SQL,
}
