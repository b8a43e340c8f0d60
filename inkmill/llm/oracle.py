"""DuckDB SQL for the training-data queries that SQL can state, by plain means instead of the operators' methods."""

from __future__ import annotations

import math

from inkmill.llm import decontam as D
from inkmill.llm import langid as L
from inkmill.llm import lmscore as M
from inkmill.llm import pii as P
from inkmill.llm import quality as Q

SPLIT = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NEAR_DUPLICATES = rf"""
with recursive words as (select doc_id, {SPLIT.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
shingles as (select distinct doc_id, s from (select doc_id, array_to_string(w[k : k + 2], ' ') as s from words, lateral (select unnest(generate_series(1, greatest(1, len(w)::bigint - 2))) as k) where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)),
reach as (select doc_id as a, doc_id as r from documents union select links.b, reach.r from reach join links on links.a = reach.a)
select d.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(reach.r) as component_id, d.doc_id = min(reach.r) as kept
from documents d join reach on reach.a = d.doc_id left join sizes on sizes.doc_id = d.doc_id group by d.doc_id"""

SUBSTRINGS = rf"""
with words as (select doc_id, {SPLIT} as w from documents),
each as (select doc_id, w, generate_subscripts(w, 1) as k, unnest(w) as word from words),
windows as (select doc_id, k, case when k + 49 <= len(w) then array_to_string(w[k : k + 49], ' ') end as s from each),
least as (select s, min(doc_id) as first_doc from windows where s is not null group by s),
judged as (select windows.doc_id, windows.k, coalesce(least.first_doc < windows.doc_id, false) as gone from windows left join least on windows.s = least.s),
covered as (select doc_id, k, max(gone::int) over (partition by doc_id order by k rows between 49 preceding and current row) as c from judged)
select words.doc_id, len(any_value(words.w))::bigint as n_words, coalesce(sum(covered.c), 0)::bigint as n_removed,
 sha256(coalesce(string_agg(each.word, ' ' order by each.k) filter (covered.c = 0), '')) as kept_sha256
from words left join each on each.doc_id = words.doc_id left join covered on covered.doc_id = each.doc_id and covered.k = each.k group by words.doc_id"""


def _distance(have: list[str], want: list[float]) -> str:
    mass = lambda p: f"(case when {p} > 0 then ({p}) * log2({p}) else 0 end)"
    known = sum(q * math.log2(q) for q in want if q)
    own, middle = " + ".join(map(mass, have)), " + ".join(mass(f"(({p}) + {q!r}) / 2") for p, q in zip(have, want))
    return f"sqrt(greatest(0, (({own}) + {known!r}) / 2 - ({middle})))"


def _quality() -> str:
    common = sorted({w for words in Q.WORD_SHARES.values() for w in words})
    by_class, by_words = [], []
    for lang in Q.CLASS_SHARES:
        by_class.append(_distance([f"c_{c}" for c in Q.CLASSES], list(Q.CLASS_SHARES[lang])))
        have = [f"w_{common.index(w)}" for w in Q.WORD_SHARES[lang]]
        rest = f"greatest(0, 1 - ({' + '.join(have)}))"
        by_words.append(_distance([*have, rest], [*Q.WORD_SHARES[lang].values(), 1 - sum(Q.WORD_SHARES[lang].values())]))
    langs = range(len(by_class))
    patterns = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]", "symbol": "[#*$%&|<>]"}
    counted = ", ".join(f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) as n_{c}" for c, p in patterns.items())
    letters = r"length(t) - length(regexp_replace(t, '\p{L}', '', 'g'))"
    return rf"""
with base as (select doc_id, lang is null or lang in ({", ".join(f"'{x}'" for x in Q.CLASS_SHARES)}) as scope, coalesce(text, '') as t, {SPLIT} as w from documents),
counted as (select doc_id, scope, t, w, len(w)::bigint as n_words, {counted}, {letters} as n_letters,
 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from base),
classes as (select *, n_letters - n_lower - n_upper as n_other, length(t) - n_letters - n_digit - n_space - n_symbol as n_punct from counted),
starts as (select doc_id, k, array_to_string(w[k : k + 2], ' ') as s from (select doc_id, w, unnest(generate_series(1, len(w)::bigint - 2)) as k from base)),
again as (select doc_id, k from (select doc_id, k, count(*) over (partition by doc_id, s) as c from starts) where c > 1),
repeats as (select doc_id, count(distinct k + d)::bigint as n from again, lateral (select unnest([0, 1, 2]) as d) group by doc_id),
shares as (select classes.doc_id, scope, n_words, (length(t) - n_space)::bigint as word_chars, n_symbol::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(repeats.n, 0)::bigint as n_repeat_words,
 {", ".join(f"n_{c} / greatest(1, length(t))::double as c_{c}" for c in Q.CLASSES)},
 {", ".join(f"len(list_filter(w, lambda x: x = '{w}')) / greatest(1, n_words)::double as w_{i}" for i, w in enumerate(common))}
 from classes left join repeats on repeats.doc_id = classes.doc_id),
apart as (select *, {", ".join(f"{d} as bc_{i}" for i, d in enumerate(by_class))}, {", ".join(f"{d} as bw_{i}" for i, d in enumerate(by_words))} from shares),
verdict as (select *, least({", ".join(f"bc_{i}" for i in langs)}) as class_distance, least({", ".join(f"bw_{i}" for i in langs)}) as word_distance, n_words < {Q.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from apart)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not base_failed and not (scope and word_chars >= {Q.GUARD_CHARS} and c_other <= c_lower + c_upper and (class_distance > {Q.MAX_CLASS_DISTANCE} or (n_words >= {Q.GUARD_WORDS} and word_distance > {Q.MAX_WORD_DISTANCE}))) as kept,
 round(class_distance, 6) as class_distance, round(word_distance, 6) as word_distance from verdict"""


def _leaks() -> str:
    """Every document against every item at every alignment that shares a word; no windows.

    RE2 has no look-around, so what stands around a name or a unit is matched and put back, and each replacement is done twice,
    as neighbours share what stands between them.
    """
    twice = lambda text, pattern, to: f"regexp_replace(regexp_replace({text}, '{pattern}', '{to}', 'g'), '{pattern}', '{to}', 'g')"
    marked = f"regexp_replace({twice("coalesce(text, '')", r"([\p{Ll},;] )(\p{Lu}\p{L})", rf"\1{D.NAME}\2")}, '[^\\p{{L}}\\p{{N}}{D.NAME}\\x20\\x09-\\x0D]+', '', 'g')"
    slots = f"lower(regexp_replace(regexp_replace(m, '{D.NAME}\\p{{L}}+', '{D.NAME}', 'g'), '[0-9]+', '{D.NUM}', 'g'))"
    template = twice(slots, rf"({D.NUM} ?)(?:{'|'.join(D.UNITS)})([^\p{{L}}\p{{N}}]|$)", rf"\1{D.UNIT}\2")
    words = lambda x: SPLIT.replace("coalesce(text, '')", x)
    return rf"""
with d as (select row_number() over () as d, doc_id, {marked} as m from documents), i as (select row_number() over () as i, item_id, {marked} as m from benchmark where item_id is not null),
dw as (select d, doc_id, generate_subscripts(w, 1) - 1 as p, unnest(w) as t, lower(unnest({words("m")})) as raw from (select *, {words(template)} as w from d)),
iw as (select i, item_id, len(w) as item_len, len(list_filter(w, lambda x: not regexp_matches(x, '[{D.NUM}{D.NAME}{D.UNIT}]'))) as plain, generate_subscripts(w, 1) - 1 as p, unnest(w) as t, lower(unnest({words("m")})) as raw from (select *, {words(template)} as w from i)),
met as (select d, doc_id, i, item_id, item_len, plain, iw.p, dw.p - iw.p as shift, iw.raw as a, dw.raw as b, regexp_matches(iw.t, '[{D.NUM}{D.NAME}{D.UNIT}]') as slot from dw join iw on dw.t = iw.t where plain >= {D.LEAST_ITEM}),
runs as (select d, i, shift, max(n) as longest_run from (select d, i, shift, count(*) as n from (select d, i, shift, p - row_number() over (partition by d, i, shift order by p) as g from met) group by d, i, shift, g) group by d, i, shift),
sums as (select d, any_value(doc_id) as doc_id, i, any_value(item_id) as item_id, shift, greatest(shift, 0) as doc_word, count(*) as matched, any_value(item_len) as item_len, any_value(plain) as plain, count(*) filter (slot) as n_slots,
 count(distinct a) filter (slot) as n_a, count(distinct b) filter (slot) as n_b, count(distinct (a, b)) filter (slot) as n_ab, bool_and(a = b) as verbatim from met group by d, i, shift having count(*) >= {D.LEAST_ITEM}),
leaks as (select * from sums join runs using (d, i, shift) where (longest_run >= {D.RUN} or matched >= {D.SHARE}::double * item_len) and matched - n_slots >= least({D.LEAST_PLAIN}, plain) and n_a = n_ab and n_b = n_ab),
best as (select *, row_number() over (partition by d, item_id order by matched desc, longest_run desc, verbatim desc, doc_word, item_len desc, n_slots desc) as k from leaks)
select distinct doc_id, item_id, doc_word::bigint as doc_word, matched::bigint as matched, longest_run::bigint as longest_run, item_len::bigint as item_len, n_slots::bigint as n_slots, verbatim from best where k = 1"""


def _crc32(text: str) -> str:
    """Bit by bit, of ASCII text."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)), lambda c, b: {bits}), 4294967295)"


def _languages() -> str:
    """N-grams cut out of strings. A code orders by length first, then by code points, as n-grams do here."""
    grams = "unnest(list_concat(list_filter(string_split(s, ''), lambda x: x <> ' '), list_transform(range(1, length(s)), lambda k: substr(s, k, 2)), list_transform(range(1, length(s) - 1), lambda k: substr(s, k, 3))))"
    return rf"""
with docs as (select row_number() over () as d, doc_id, lang, {_crc32("doc_id::varchar")} % 3 = 1 as held_out, {_crc32("'sample ' || doc_id::varchar")} % 1048576 as pick,
 ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ' as s from documents),
known as (select *, least(1.0::double, {L.PER_LANGUAGE}::double / count(*) over (partition by lang)) as share from docs where not held_out and lang is not null and doc_id is not null),
grams as (select d, g, count(*) as n from (select d, {grams} as g from docs where length(s) > 2) group by d, g),
learned as (select lang, g, sum(n) as n from grams join known using (d) where pick < share * 1048576 group by lang, g),
profiles as (select lang, g, k - 1 as r from (select *, row_number() over (partition by lang order by n desc, length(g), g) as k from learned) where k <= {L.PROFILE}),
own as (select d, g, k - 1 as r from (select *, row_number() over (partition by d order by n desc, length(g), g) as k from grams) where k <= {L.PROFILE}),
apart as (select d, langs.lang, sum(coalesce(abs(profiles.r - own.r), {L.PROFILE})) as x, count(*) as size from own cross join (select distinct lang from profiles) langs left join profiles on profiles.lang = langs.lang and profiles.g = own.g group by d, langs.lang),
placed as (select *, row_number() over (partition by d order by x, lang) as k from apart),
best as (select d, max(lang) filter (k = 1) as lang, max(x) filter (k = 1) as x, coalesce(max(x) filter (k = 2), {L.PROFILE} * max(size)) as second from placed group by d)
select doc_id, coalesce(held_out, false) as held_out, coalesce(best.lang, 'und') as lang_pred, coalesce(case when second = 0 then 0 else (second - x)::double / second::double end, 0::double) as score from docs left join best using (d)"""


def _scores() -> str:
    """Counts by windows over all words; the empty string stands for a text's start."""
    # of a token, by the words it is counted as: in all texts, in the target's, and in its own
    counted = lambda name, by: f"count(*) over (partition by {by}) as {name}_0, count(*) filter (goal) over (partition by {by}) as {name}_1, count(*) over (partition by d, {by}) as {name}_own"
    left = lambda name, g: f"({name}_{g} - {'case when goal then ' + name + '_own else 0 end' if g else name + '_own'})"
    scale = {0: "(case when all_1 > 0 then all_1::double / all_0 else 1.0::double end)", 1: "1.0::double"}

    def loss(g: int) -> str:
        whole = f"(all_{g} - {'case when goal then n else 0 end' if g else 'n'})"
        alone = f"(({left('word', g)} * {scale[g]} + {M.ADD}::double) / ({whole} * {scale[g]} + {M.ADD}::double * vocabulary))"
        return f"-ln(case when {left('before', g)} > 0 then {M.PAIR_WEIGHT}::double * {left('pair', g)} / {left('before', g)} + {1 - M.PAIR_WEIGHT!r}::double * {alone} else {alone} end)"

    lower = SPLIT.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return rf"""
with docs as (select row_number() over () as d, doc_id, coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false) as goal, {lower} as w from documents),
tokens as (select d, goal, len(w) as n, generate_subscripts(w, 1) as k, unnest(w) as b from docs),
each as (select d, goal, n, k, b, coalesce(lag(b) over (partition by d order by k), '') as a from tokens),
words as (select *, {counted("word", "b")}, {counted("pair", "a, b")} from each),
starts as (select count(*) filter (len(w) > 0) as before_0, count(*) filter (len(w) > 0 and goal) as before_1 from docs),
known as (select d, b as a, any_value(word_0) as before_0, any_value(word_1) as before_1, any_value(word_own) as before_own from words group by d, b union all select d, '', before_0, before_1, 1 from docs, starts where len(w) > 0),
totals as (select count(*) as all_0, count(*) filter (goal) as all_1, greatest({1 << M.WORD_BITS}, count(distinct b)) as vocabulary from tokens),
means as (select d, sum({loss(1)}) / count(*) as target, sum({loss(0)}) / count(*) as background from words join known using (d, a), totals group by d)
select doc_id, len(w)::bigint as n_tokens, round(target, 6) as loss_target, round(background, 6) as loss_background, round(coalesce(background - target, 0), 6) as score from docs left join means using (d)"""


def _personal_data() -> str:
    """Matches of each pattern, placed by the lengths of what stands between them; look-around as conditions on the neighbours."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    found = " union all ".join(f"select d, doc_id, t, {i} as o, '{kind}' as kind, regexp_extract_all(t, '{p}') as ms, string_split_regex(t, '{p}') as ps from texts" for i, (kind, p) in enumerate(patterns.items()))
    luhn = "list_sum(list_transform(range(1, length(x) + 1), lambda i: case when i % 2 = 1 then x[-i]::int else 2 * x[-i]::int - 9 * (x[-i]::int > 4)::int end)) % 10 = 0"
    mod = "list_reduce(list_concat([0::bigint], list_transform(string_split(substr(c, 5) || substr(c, 1, 4), ''), lambda x: case when ascii(x) < 58 then ascii(x) - 48 else ascii(x) - 55 end::bigint)), lambda r, x: (r * (case when x < 10 then 10 else 100 end) + x) % 97) = 1"
    lengths = "map {" + ", ".join(f"'{k}': {n}" for k, n in P.IBAN_LENGTH.items()) + "}"
    of_kind = lambda table: "case kind " + " ".join(f"when '{k}' then {table(k)}" for k in patterns) + " end"
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    total = lambda values: f"coalesce(list_sum(list_transform({values}, lambda x: length(x))), 0)"
    span = "kind || ':' || a || ':' || b"
    return rf"""
with texts as (select row_number() over () as d, doc_id, coalesce(text, '') as t from documents),
found as ({found}),
placed as (select d, doc_id, t, o, kind, ms[k] as m, ({total("ps[1:k]")} + {total("ms[1:k-1]")})::bigint as a, regexp_replace(ms[k], '[^0-9]', '', 'g') as x from (select *, unnest(range(1, len(ms) + 1)) as k from found)),
ends as (select *, case when kind <> 'iban' then m else regexp_extract(regexp_extract(substr(t, a + 1, 70), '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}'), '^(?:[A-Z0-9] ?){{' || coalesce({lengths}[substr(m, 1, 2)] - 1, 0) || '}}[A-Z0-9]') end as whole from placed),
sound as (select *, a + length(whole) as b, replace(whole, ' ', '') as c, case when a > 0 then substr(t, a, 1) else '' end as before, substr(t, a + length(whole) + 1, 1) as after from ends where whole <> ''),
valid as (select * from sound where case kind when 'email' then true
 when 'ip' then len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(try_cast(p as int), 0) > 255)) = 0
 when 'card' then length(x) between 16 and 19 and {luhn} when 'phone' then length(x) between 8 and 15
 when 'iban' then not regexp_matches(before, '[A-Za-z0-9]') and not regexp_matches(after, '[\p{{L}}\p{{N}}]') and length(c) = {lengths}[substr(m, 1, 2)] and {mod}
 else not regexp_matches(before, '[0-9-]') and not regexp_matches(after, '[0-9-]') and not regexp_matches(m, '^(000|666|9)|-00-|-0000$') end),
near as (select *, regexp_extract_all(lower(substr(t, greatest(0, a - {P.NEAR}) + 1, a - greatest(0, a - {P.NEAR})) || ' ' || substr(t, b + 1, {P.NEAR})), '[a-z-]+') as words from valid),
scored as (select *, round(least(1, greatest(0, {of_kind(lambda k: f"{P.PRIOR[k]}::double")} + {P.BONUS}::double * list_has_any(words, {of_kind(lambda k: listed(P.CONTEXT[k]))})::int - {P.MALUS}::double * list_has_any(words, {listed(P.AGAINST)})::int)), 3) as score from near),
kept as (select * from scored where kind in {tuple(P.BASE)} or score >= {P.LEAST}),
sums as (select d, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in patterns)}, string_agg({span}, ',' order by o, a) filter (kind in {tuple(P.BASE)}) as base, string_agg({span}, ',' order by o, a) as spans, max(score) as top from kept group by d)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in patterns)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(top, 0::double) as top_score from texts left join sums using (d)"""


ORACLE = {"op3_pii": _personal_data(), "op4_lm_scoring": _scores(), "op2_language_id": _languages(), "op10_decontamination": _leaks(), "op5_near_duplicates": NEAR_DUPLICATES, "op6_substring_dedup": SUBSTRINGS, "op7_quality": _quality()}
