"""The corpus queries as DuckDB SQL, for those that SQL can express."""

from __future__ import annotations

from tallyforge.llm import secretscan
from tallyforge.llm.rules import BOILERPLATE, NAVIGATION

WORDS = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SAID = "<|im_end|><|im_start|>assistant ok"

# Escaped lengths follow from what the escapes add: one sign for each backslash, each control
# opening, a "<" at the end, and in a role for each line feed.
CHAT = rf"""with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{SAID}' union all select -1, 1, 'assistant', '{SAID}'),
sized as (select *,
  length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + ends_with(role, '<')::int as role_chars,
  length(replace(replace(text, '\', '\\'), '<|', '<\|')) + ends_with(text, '<')::int as text_chars from said)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + role_chars + 1 + text_chars + length('<|im_end|>') + 1) as bigint) as formatted_chars
from sized group by conv_id"""

JACCARD = rf"""with recursive listed as (
  select doc_id, coalesce(regexp_extract_all(translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '{WORDS}'), []) as w from documents),
shingles as (select distinct doc_id, unnest(case
    when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from listed),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as common from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * common >= 85 * (a.n + b.n - common)),
reached as (select doc_id as d, doc_id as r from documents union select d, y from reached join links on x = r)
select l.doc_id, coalesce(any_value(n), 0) as n_shingles, min(r) as component_id, (select count(*) from links where x = l.doc_id) as n_links
from listed l join reached on d = l.doc_id left join sizes on sizes.doc_id = l.doc_id group by l.doc_id"""

SUBSTRINGS = rf"""with listed as (select doc_id, coalesce(regexp_extract_all(text, '{WORDS}'), []) as w from documents),
words as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from listed),
starts as (select doc_id, unnest(range(1, len(w) - 11)) as p,
  unnest(list_transform(range(1, len(w) - 11), lambda i: md5(array_to_string(w[i:i + 12], ' ')))) as run from listed),
firsts as (select run, min(doc_id) as first from starts group by run having count(*) > 1),
judged as (select doc_id, p, true as repeats from starts join firsts using (run) where first < doc_id),
marked as (select doc_id, p, word, coalesce(max(case when repeats then p end)
  over (partition by doc_id order by p) >= p - 12, false) as gone from words left join judged using (doc_id, p))
select l.doc_id, cast(len(any_value(w)) as bigint) as n_words, cast(coalesce(count_if(gone), 0) as bigint) as n_removed,
  sha256(coalesce(string_agg(word, ' ' order by p) filter (not gone), '')) as kept_sha256
from listed l left join marked using (doc_id) group by l.doc_id"""

# The rules of ``rules.LineRules`` with their default limits.
RULES = rf"""with listed as (select doc_id, coalesce(text, '') as text, coalesce(regexp_extract_all(text, '{WORDS}'), []) as w from documents),
trigrams as (select doc_id, unnest(range(1, len(w) - 1)) as p,
  unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) as run from listed),
twice as (select doc_id, p from trigrams qualify count(*) over (partition by doc_id, run) > 1),
repeated as (select doc_id, count(distinct p + k) as n from twice cross join (select unnest([0, 1, 2]) as k) group by doc_id),
lines as (select doc_id, line, regexp_extract_all(line, '{WORDS}') as w from (select doc_id, unnest(string_split(text, chr(10))) as line from listed)),
counted as (select doc_id, line, len(w) as n, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) as chars,
  length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) as symbols, length(regexp_replace(line, '[^!]', '', 'g')) as shouts,
  length(regexp_replace(line, '[^\p{{Lu}}]', '', 'g')) as upper, length(regexp_replace(line, '[^\p{{Ll}}]', '', 'g')) as lower,
  length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) as letters, len(regexp_extract_all(line, '{NAVIGATION.pattern}')) as marks,
  len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) as stutters from lines where len(w) > 0),
failing as (select *, symbols > 0.5 * n or shouts > 0.5 * n or (letters >= 20 and upper > lower and upper >= 0.7 * letters)
  or (n >= 6 and stutters >= 0.5 * n) or (marks >= 2 and n - marks <= 4 * (marks + 1))
  or (n <= 25 and regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$'))
  or (n <= 25 and regexp_matches(line, '{BOILERPLATE.pattern}', 'i')) as fails from counted),
by_doc as (select doc_id, count(*) - count(distinct line) as dup, coalesce(sum(chars) filter (fails), 0) as lost from failing group by doc_id),
measured as (select doc_id, cast(len(w) as bigint) as n_words, length(array_to_string(w, '')) as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dup, 0) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
  coalesce(lost, 0) as lost from listed left join by_doc using (doc_id) left join repeated using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and lost <= 0.5 * word_chars as kept from measured"""

# Words by piece of text; every phrase of up to five words, and the counts of all its parts.
COLLOCATIONS = rf"""with pieces as (select coalesce(lang, 'und') as lang, doc_id, unnest(range(1, len(p) + 1)) as piece, unnest(p) as said from (
  select lang, doc_id, regexp_split_to_array(translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '[.,;:!?\x0A-\x0D]') as p from documents)),
words as (select lang, regexp_extract_all(said, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
phrases as (select lang, size, phrase, count(*) as a from (select lang, size, unnest(list_transform(range(1, len(w) - size + 2),
  lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase from words, (select unnest(range(1, 6)) as size)) group by all having count(*) >= 100),
cuts as (select lang, phrase, size, a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail
  from (select *, string_split(phrase, ' ') as w, unnest(range(1, size)) as k from phrases where size > 1)),
scored as (select c.lang, c.phrase, c.size, c.a, x.a as l, y.a as r, n,
    cast(1000::hugeint * c.a::hugeint * n::hugeint // (x.a::hugeint * y.a::hugeint) as bigint) as score
  from cuts c join phrases x on x.lang = c.lang and x.phrase = head join phrases y on y.lang = c.lang and y.phrase = tail join totals t on t.lang = c.lang
  qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1),
kept as (select * from scored s where not exists (select 1 from phrases p where p.lang = s.lang and p.size > s.size and p.a >= s.a
  and contains(' ' || p.phrase || ' ', ' ' || s.phrase || ' '))),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000"""

# CRC-32 has no function in DuckDB: a table of the 256 byte steps, made by eight shifts, and a fold
# over the bytes of each different word.
RESAMPLING = rf"""with recursive shifts as (select range as byte, range as v, 0 as k from range(256) union all
  select byte, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from shifts where k < 8),
steps as (select list(v order by byte) as t from shifts where k = 8),
docs as (select doc_id, coalesce(regexp_extract_all(translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
items as (select unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
words as (select doc_id, unnest(w) as word from docs),
known as (select word, hex(encode(word)) as h from (select word from words union select word from items)),
hashed as (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::bigint)),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 as bucket from known, steps),
source as (select bucket, count(*) as s from words join hashed using (word) group by bucket),
target as (select bucket, count(*) as t from items join hashed using (word) group by bucket),
gains as (select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from words) + 10000)
  / ((coalesce(s, 0) + 1)::double * ((select count(*) from items) + 10000)))) as bigint) as gain from source full join target using (bucket)),
weights as (select doc_id, cast(floor(sum(gain)::double / count(*)) as bigint) as weight from words join hashed using (word) join gains using (bucket) group by doc_id),
scored as (select d.doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::bigint + 0.5::double) / 4294967296))) as bigint) as score
  from docs d left join weights using (doc_id)),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as able from scored where n_features >= 20)
select s.doc_id, n_features, weight, score, case when rank <= 10 * able // 100 then rank end as rank from scored s left join ranked using (doc_id)"""



def _occurrences(name: str, pattern: str, least: str = "true") -> str:
    """Common table (doc_id, start, said, stop) of the matches of a pattern in ``docs``."""
    pattern = pattern.replace("'", "''")
    return f"""{name}_lists as (select doc_id, regexp_extract_all(text, '{pattern}') as m, list_transform(regexp_split_to_array(text, '{pattern}'), lambda g: length(g)) as gaps from docs),
{name} as (select *, start + length(said) as stop from (select doc_id, unnest(m) as said, unnest(list_transform(range(1, len(m) + 1), lambda i:
  list_sum(gaps[1:i]) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)))::bigint as start from {name}_lists) where {least})"""


def _tail(z: str) -> str:
    x = f"greatest(abs({z}), 1e-6)"
    upper = f"((1 - exp(-1.4 * {x})) * exp(-{x} * {x} / 2) / (1.135 * 2.5066282746310002 * {x}))"
    return f"(case when {z} >= 0 then {upper} else 1 - {upper} end)"


_ASSIGN = secretscan.ASSIGN.replace("(?i:", "(?:")
for _word in ("password", "passwd", "secret", "token", "api", "key"):
    _ASSIGN = _ASSIGN.replace(_word, "".join(f"[{c.upper()}{c}]" for c in _word), 1)
_VALUE = _ASSIGN.replace("'", "''")
_ALPHABETS = ", ".join(f"({k}, '{a}')" for k, a in enumerate(secretscan.ALPHABETS))

# The same battery; parts of very long runs are left out, as no table has them.
SECRETS = rf"""with docs as (select doc_id, coalesce(text, '') as text from documents),
{_occurrences("assigned", _ASSIGN, f"length(regexp_extract(said, '{_VALUE}', 2)) >= 8")},
{_occurrences("access", secretscan.ACCESS)},
{_occurrences("hexes", secretscan.HEX)},
{_occurrences("runs", "[A-Za-z0-9+/_-]{20,}={0,2}", "not regexp_full_match(said, '[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}')")},
coded as (select *, rtrim(said, '=') as body from runs, (values {_ALPHABETS}) t(k, alphabet)
  where regexp_full_match(rtrim(said, '='), '[' || replace(alphabet, '-', '\-') || ']+') qualify row_number() over (partition by doc_id, start order by k) = 1),
symbols as (select doc_id, start, stop, length(body)::double as n, length(alphabet)::double as k,
  list_transform(range(1, length(body) + 1), lambda i: strpos(alphabet, body[i])::double) as v,
  list_sum(list_transform(range(1, length(alphabet) + 1), lambda i: power(length(body) - length(replace(body, alphabet[i], '')), 2)))::double as squares from coded),
centred as (select *, list_transform(v, lambda x: x - list_avg(v)) as c, list_transform(v, lambda x: x > k // 2) as up from symbols),
measured as (select *, k / n * squares - n as chi, len(list_filter(up, lambda x: x))::double as high,
  1 + len(list_filter(range(1, len(v)), lambda i: up[i] <> up[i + 1])) as changes, list_sum(list_transform(c, lambda x: x * x)) as own,
  list_sum(list_transform(range(1, len(v)), lambda i: c[i] * c[i + 1])) as pairs from centred),
scores as (select *, (chi - (k - 1)) / sqrt(2 * (k - 1) * (1 - 1 / n)) as z1, 1 + 2 * high * (n - high) / n as want,
  case when own > 0 then abs(pairs / own + 1 / (n - 1)) * sqrt(n) end as z3, n * greatest(k * 0.062 - 1, 0.5) as away from measured),
tests as (select *, abs(changes - want) / sqrt(greatest((want - 1) * (want - 2) / (n - 1), 1e-9)) as z2, (k - 1 + away - chi) / sqrt(2 * (k - 1) + 6 * away) as z4 from scores),
chances as (select *, -(ln(greatest({_tail("z1")}, 1e-300)) + ln(greatest(2 * {_tail("z2")}, 1e-300)) + ln(greatest(coalesce(2 * {_tail("z3")}, 0), 1e-300))) as y,
  {_tail("z4")} as plain from tests),
steps as (select doc_id, start, stop, n, case when exp(-y) * (1 + y + y * y / 2) >= 0.01
  then floor(-20 * ln(greatest(plain, 1e-300)) / 2.302585092994046) else 0 end as step from chances),
weighted as (select *, power(10.0, -step / 20.0) * (select sum(n) / count(*) from steps) / n as chance from steps),
cut as (select max(chance) as most from (select chance, count(*) over (order by chance range unbounded preceding) as upto, count(*) over () as n from weighted)
  where chance * n <= 0.01 * upto),
spans as (select doc_id, start, 0 as kind, 'assign' as name, stop from assigned union all select doc_id, start, 1, 'access', stop from access
  union all select doc_id, start, 2, 'hex', stop from hexes union all select doc_id, start, 3, 'random', stop from weighted, cut where chance <= most),
listed as (select doc_id, kind, start, concat(name, ':', start, ':', stop) as span from spans)
select d.doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
  sha256(coalesce(string_agg(span, ',' order by start, kind) filter (kind < 3), '')) as base_sha256,
  coalesce(string_agg(span, ',' order by start, kind), '') as spans
from docs d left join listed l using (doc_id) group by d.doc_id"""

SQL = {
    "op2_chat_formatting": CHAT,
    "op3_ngram_jaccard_join": JACCARD,
    "op5_substring_dedup": SUBSTRINGS,
    "op7_quality_rules": RULES,
    "op11_phrase_collocation_mining": COLLOCATIONS,
    "op12_target_distribution_importance_resampling": RESAMPLING,
    "op13_secret_scans": SECRETS,
}
