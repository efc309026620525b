"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

from tilewright.llm import credential_links as credentials
from tilewright.llm import license_scan as licenses
from tilewright.llm import phrases
from tilewright.llm import quality_rules as rules


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    spelled = "' ' || replace(trim(regexp_replace(low, '" + licenses.OTHER + "', ' ', 'g')), ' ', '  ') || ' '"
    for old, new in licenses.SPELLINGS.items():
        spelled = f"replace({spelled}, ' {old} ', ' {new} ')"
    texts = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licenses.TEXTS)
    digests = ", ".join(f"({_text(name)}, {_text(digest)})" for name, digest in licenses.DIGESTS)
    lower = f"translate(t, '{licenses._UPPER}', '{licenses._LOWER}')"
    form = lambda kept: f"sha256(coalesce(string_agg(c, ' ' order by j){kept}, ''))"
    return f"""
    with texts as (select -row_number() over () as rid, license, text from (values {texts}) v(license, text)),
    rows as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
    whole as (select rid, text from texts union all select rid, text from rows),
    cut as (select rid, generate_subscripts(string_split(text, chr(10)), 1) as i, unnest(string_split(text, chr(10))) as t from whole),
    low as (select rid, i, {lower} as low from cut),
    canon as (select * from (select rid, i, low, trim(replace({spelled}, '  ', ' ')) as c from low) where c <> ''),
    kind as (select rid, c, row_number() over (partition by rid order by i) as j, case when regexp_matches(low, '{licenses.MARKED}') then 's'
      when regexp_matches(low, '{licenses.BEGUN}') then 'c' when c = '{licenses.RIGHTS}' then 'r'
      when length(c) - length(replace(c, ' ', '')) < {licenses.TITLE_WORDS} then 't' else 'x' end as k from canon),
    head as (select rid, length(regexp_extract(string_agg(k, '' order by j), '{licenses.HEAD}')) as n,
      length(regexp_extract(string_agg(k, '' order by j), '{licenses.LEAD}')) as lead from kind group by rid),
    judged as (select rid, c, j, j <= n and k in ('s', 'c', 'r') as heading, j <= lead as before,
      k = 's' or k = 'r' and coalesce(lag(k) over (partition by rid order by j) = 's', false) as marked from kind join head using (rid)),
    forms as (select rid, {form(" filter (not heading and not marked)")} as f1, {form(" filter (not heading)")} as f2,
      {form(" filter (not before)")} as f3, {form(" filter (not marked)")} as f4, {form("")} as f5 from judged group by rid),
    each as (select rid, 1 as place, f1 as digest from forms union all select rid, 2, f2 from forms
      union all select rid, 3, f3 from forms union all select rid, 4, f4 from forms union all select rid, 5, f5 from forms),
    known as (select digest, min(license) as license from (select license, digest from texts join each using (rid)
      union all select license, digest from (values {digests}) v(license, digest)) where digest <> sha256('') group by digest),
    hit as (select rid, arg_min(license, place) as license from each join known using (digest) where rid > 0 group by rid),
    notice as (select rid, count(*) as n, array_to_string(list_sort(list(distinct license)), ',') as names
      from kind join known on sha256(c) = digest where rid > 0 group by rid)
    select doc_id, coalesce(f1, sha256('')) as text_digest, hit.license, coalesce(notice.n, 0)::bigint as n_notices, coalesce(names, '') as notices
    from rows left join forms using (rid) left join hit using (rid) left join notice using (rid)
    """


def quality_rules() -> str:
    ws = r"[\x20\x09-\x0D]"
    grid = ", ".join(f"('{rule}', {cutoff!r}::double)" for rule, cutoffs in rules.GRID.items() for cutoff in cutoffs)
    p = rules.RISK / len(rules.GRID)
    return f"""
    with d as (select row_number() over () rid, doc_id, trim(coalesce(lang, '')) lang, coalesce(text, '') as text from documents),
    w as (select rid, doc_id, lang, text, list_filter(regexp_split_to_array(text, '{ws}+'), lambda x: x <> '') words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) lines from d),
    win as (select rid, unnest(range(1, len(words) - 3)) i, words from w where len(words) >= 5),
    g as (select rid, i, array_to_string(words[i:i + 4], ' ') win from win),
    r as (select rid, i from (select rid, i, count(*) over (partition by rid, win) c from g) where c > 1),
    hit as (select rid, count(distinct i + k) n from r, range(0, 5) t(k) group by rid),
    f as (select w.rid, doc_id, lang, len(words)::bigint n_words, length(array_to_string(words, ''))::bigint word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
      length(regexp_replace(text, '[^!]', '', 'g'))::bigint n_bangs,
      len(lines)::bigint n_lines, (len(lines) - len(list_distinct(lines)))::bigint n_dup_lines,
      coalesce(hit.n, 0)::bigint n_repeat_words from w left join hit using (rid)),
    s as (select *, n_symbols / greatest(n_words, 1) symbols, n_bangs / greatest(n_words, 1) bangs,
      n_dup_lines / greatest(n_lines, 1) dup_lines, n_repeat_words / greatest(n_words, 1) repeats from f),
    long as (unpivot (select rid, doc_id, lang, symbols::double symbols, bangs::double bangs, dup_lines::double dup_lines,
      repeats::double repeats from s) on symbols, bangs, dup_lines, repeats into name rule value x),
    label as (select doc_id, min(quality) quality from labels where doc_id is not null and quality is not null group by 1),
    grid as (select * from (values {grid}) v(rule, cutoff)),
    c as (select lang, rule, cutoff, count(*) filter (quality = 1) n, count(*) filter (quality = 1 and x >= cutoff) k,
      count(*) filter (quality <> 1 and x >= cutoff) caught
      from long join label using (doc_id) join grid using (rule) group by all),
    tail as (select *, (select count(*) from c) tests, case when n > 0 and k < n * {p!r} then
      list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r}))))
      else 1 end tail from c),
    cut as (select lang, rule, arg_max(cutoff, {{'a': caught - {rules.COST} * k, 'b': cutoff}}) cutoff from tail
      where tail <= {rules.DELTA!r} / tests and caught > {rules.COST} * k group by all),
    failed as (select rid, count(*) n from long join cut using (lang, rule) where x >= cutoff group by rid)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
      not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and failed.n is null kept
    from f left join failed using (rid)
    """


WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), []::varchar[])"


def substring_dedup() -> str:
    return f"""
    with d as (select doc_id, {WORDS.format("text")} as words from documents),
    w as (select doc_id, words, unnest(range(1, len(words) - 48)) as i from d where len(words) >= 50),
    h as (select doc_id, i, array_to_string(words[i:i + 49], ' ') as win from w),
    low as (select win, min(doc_id) as first from h group by win),
    gone as (select distinct doc_id, i + k as p from h join low using (win), range(0, 50) t(k) where first < doc_id),
    place as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as p from d),
    kept as (select doc_id, string_agg(word, ' ' order by p) as kept from place anti join gone using (doc_id, p) group by doc_id),
    n as (select doc_id, count(*) as n from gone group by doc_id)
    select doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
    from d left join n using (doc_id) left join kept using (doc_id)
    """


def near_dedup() -> str:
    lower = f"translate(text, '{licenses._UPPER}', '{licenses._LOWER}')"
    return f"""
    with recursive d as (select doc_id, {WORDS.format(lower)} as words from documents),
    s as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as sh
          from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from d where len(words) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    common as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
    link as (select x, y from common join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 75 * (a.n + b.n - c)),
    edge as (select x, y from link union all select y, x from link),
    reach as (select x, y from edge union select r.x, e.y from reach r join edge e on r.y = e.x),
    low as (select x as doc_id, min(y) as component from reach group by x)
    select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component, doc_id) as component_id, coalesce(component, doc_id) = doc_id as kept
    from d left join n using (doc_id) left join low using (doc_id)
    """


def collocations() -> str:
    lower = f"translate(coalesce(text, ''), '{licenses._UPPER}', '{licenses._LOWER}')"
    return f"""
    with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from d),
    g as (select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase
      from (select lang, k, words, unnest(range(1, len(words) - k + 2)) as i from w, range(1, {phrases.LONGEST + 1}) t(k) where len(words) >= k)),
    f as (select lang, k, phrase, count(*) as f from g group by all),
    total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
    c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as words from f where k > 1 and f >= {phrases.THRESHOLD}),
    cut as (select lang, k, phrase, a, j, array_to_string(words[1:j], ' ') as head, array_to_string(words[j + 1:], ' ') as tail
      from (select *, unnest(range(1, k)) as j from c)),
    s as (select cut.*, h.f as l, t.f as r, (1000000::hugeint * a * a) // (h.f::hugeint * t.f) as score
      from cut join f h on h.lang = cut.lang and h.phrase = head join f t on t.lang = cut.lang and t.phrase = tail),
    low as (select lang, k, phrase, a, arg_min({{'l': l, 'r': r, 's': score}}, {{'s': score, 'j': j}}) as v from s group by all),
    kept as (select * from low where not exists (select 1 from c where c.lang = low.lang and c.k > low.k and 100 * c.a >= {phrases.SHARE} * low.a
      and contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' '))),
    ranked as (select lang, row_number() over (partition by lang order by v.s desc, a desc, phrase) as rank, phrase, a, v.l as l, v.r as r, v.s as score from kept)
    select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join total using (lang) where rank <= {phrases.TOP}
    """


def secrets() -> str:
    quoted = lambda p: p.regex.replace("'", "''")
    found = " union all ".join(
        f"select rid, {n} as pattern, '{p.kind}' as kind, '{p.role}' as role, {p.strong} as strong, {p.least} as least, {p.most} as most, "
        f"regexp_split_to_array(text, '{quoted(p)}') as gaps, regexp_extract_all(text, '{quoted(p)}', 0) as hits, "
        f"regexp_extract_all(text, '{quoted(p)}', {p.group}) as parts from d where regexp_matches(text, '{quoted(p)}')"
        for n, p in enumerate(credentials.PATTERNS)
    )
    complete = " or ".join(
        f"pattern = {n} and ({' or '.join('(' + ' and '.join(f'near_{role}' for role in roles) + ')' for roles in p.needs)})"
        for n, p in enumerate(credentials.PATTERNS)
        if not p.strong
    )
    reach = credentials.REACH
    near = ", ".join(f"bool_or(b.role = '{role}') as near_{role}" for role in credentials.ROLES)
    kinds = "[" + ", ".join(f"'{kind}'" for kind in credentials.KINDS) + "]"
    return f"""
    with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
    found as ({found}),
    each as (select * exclude (gaps, hits, parts), i, length(gaps[i]) as gap, length(hits[i]) as long, length(parts[i]) as part
      from (select *, unnest(range(1, len(hits) + 1)) as i from found)),
    placed as (select *, sum(gap + long) over (partition by rid, pattern order by i) as stop from each),
    p as (select rid, pattern, kind, role, strong, (stop - long)::bigint as start, stop::bigint as stop from placed where part between least and most),
    seen as (select a.rid, a.pattern, a.kind, a.start, a.stop, bool_or(b.strong and b.start < a.stop and b.stop > a.start) as covered, {near}
      from p a join p b on a.rid = b.rid and b.start < a.stop + {reach} and b.stop > a.start - {reach} where not a.strong group by all),
    spans as (select rid, kind, true as strong, start, stop from p where strong
      union select rid, kind, false, start, stop from seen where not covered and ({complete})),
    named as (select *, kind || ':' || start || ':' || stop as name, list_position({kinds}, kind) as place from spans),
    r as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
      string_agg(name, ',' order by start, place, stop) filter (strong) as base, string_agg(name, ',' order by start, place, stop) as spans from named group by rid)
    select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
      sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join r using (rid)
    """
