"""DuckDB SQL for the queries that SQL can express: plain joins where the operators use hashed keys."""

from __future__ import annotations

from trafficspark.llm.decontamination import UNITS

_UNITS = ", ".join(f"'{u}'" for u in UNITS)

LINE_DEDUP = """
with docs as (select doc_id, text, string_split(text, chr(10)) as all_lines from documents),
occurrences as (
  select doc_id, i - 1 as line_no, all_lines[i] as line
  from (select doc_id, all_lines, unnest(range(1, len(all_lines) + 1)) as i from docs)
  where length(all_lines[i]) >= 20),
lines as (select line, length(line) as n, min((doc_id, line_no)) as first from occurrences group by line),
based as (select line, first, n as base from lines union all select line, first, n - 1 from lines),
pairs as (
  select a.line as line, b.first as near from based a join based b
    on a.base = b.base and left(a.line, (a.base // 2)) = left(b.line, (b.base // 2))
   and b.first < a.first and levenshtein(a.line, b.line) <= 1
  union all
  select a.line, b.first from based a join based b
    on a.base = b.base and right(a.line, (a.base // 2)) = right(b.line, (b.base // 2))
   and b.first < a.first and levenshtein(a.line, b.line) <= 1),
nearest as (select line, min(near) as near from pairs group by line),
gone as (
  select doc_id, line_no from occurrences join lines using (line) left join nearest using (line)
  where near is not null or (doc_id, line_no) <> first),
by_doc as (select doc_id, list(line_no) as marks from gone group by doc_id),
kept as (
  select doc_id, text, all_lines,
    case when marks is null then all_lines
         else list_filter(all_lines, lambda x, i: not list_contains(marks, i - 1)) end as lines_left
  from docs left join by_doc using (doc_id))
select doc_id, case when text is null then 0 else len(all_lines) end::bigint as n_lines,
  case when text is null then 0 else len(all_lines) - len(lines_left) end::bigint as n_removed,
  length(coalesce(array_to_string(lines_left, chr(10)), ''))::bigint as kept_chars,
  sha256(coalesce(array_to_string(lines_left, chr(10)), '')) as kept_sha256
from kept
"""


def _templated(source: str, columns: str) -> str:
    return f"""
  select {columns}, words, typed, list_transform(words, lambda t, i: case when typed[i] <> t then t end) as vals from (
    select {columns}, words, list_transform(words, lambda t, i:
      case when t < ':' then case when t < '0' then '<name>' else '<num>' end
           when i > 1 and words[i - 1] < ':' and words[i - 1] >= '0' and t in ({_UNITS}) then '<unit>'
           else t end) as typed from (
      select {columns}, regexp_extract_all(lower(regexp_replace(txt, '(^|[^\\p{{L}}\\p{{M}}])(\\p{{Lu}})', '\\1' || chr(2) || '\\2', 'g')),
        chr(2) || '?[\\p{{L}}\\p{{M}}]+|[0-9]+(?:[.,][0-9]+)*') as words from {source}))"""


_WINDOW = """list_transform(typed[i:i + n - 1], lambda x: x) as win, list_filter(vals[i:i + n - 1], lambda x: x is not null) as slots"""

DECONTAMINATION = f"""
with items as ({_templated("(select item_id, text as txt from benchmark where text is not null)", "item_id")}),
sized as (select *, least(len(typed), 8) as n from items where len(typed) >= 5),
item_starts as (select *, unnest(range(1, len(typed) - n + 2)) as i from sized),
item_windows as (
  select distinct item_id, i as item_pos, n, {_WINDOW} from item_starts
  where len(list_filter(typed[i:i + n - 1], lambda t: t not in ('<num>', '<name>', '<unit>'))) >= 5),
sizes as (select item_id, count(distinct item_pos) as item_windows from item_windows group by item_id),
docs as ({_templated("(select doc_id, text as txt from documents)", "doc_id")}),
lengths as (select distinct n from item_windows),
doc_starts as (select doc_id, typed, vals, n, unnest(range(1, len(typed) - n + 2)) as i from docs, lengths where len(typed) >= n),
doc_windows as (select doc_id, i, n, {_WINDOW} from doc_starts),
met as (
  select d.doc_id, w.item_id, d.i - w.item_pos as shift, w.item_pos, d.slots as doc_slots, w.slots as item_slots
  from doc_windows d join item_windows w on d.n = w.n and d.win = w.win),
bound as (select doc_id, item_id, shift, unnest(item_slots) as a, unnest(doc_slots) as b from met),
renamed as (
  select doc_id, item_id, shift, count(distinct a) = count(distinct b) and count(distinct a) = count(distinct (a, b)) as one
  from bound group by doc_id, item_id, shift),
pairs as (
  select doc_id, item_id, count(distinct item_pos) as n_windows from met left join renamed using (doc_id, item_id, shift)
  where doc_slots = item_slots or coalesce(one, true) group by doc_id, item_id)
select doc_id, item_id, n_windows::bigint as n_windows, item_windows::bigint as item_windows
from pairs join sizes using (item_id) where n_windows >= least(2, item_windows)
"""

BM25 = """
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) as term from documents),
counts as (select doc_id, term, count(*) as n from words group by doc_id, term),
lengths as (select d.doc_id, coalesce(sum(c.n), 0)::double as size from (select doc_id from documents) d left join counts c using (doc_id) group by d.doc_id),
total as (select count(*)::double as docs, avg(size) as mean from lengths),
frequency as (select term, count(*)::double as df from counts group by term),
scores as (
  select q.doc_id as query_id, c.doc_id,
    round(sum(q.n * ln(1 + (docs - df + 0.5) / (df + 0.5)) * c.n * 2.2e0 / (c.n + 1.2e0 * (0.25e0 + 0.75e0 * size / mean))), 6) as score
  from counts q join counts c using (term) join frequency using (term) join lengths l on l.doc_id = c.doc_id cross join total
  where q.doc_id % 20 = 0 group by q.doc_id, c.doc_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from scores)
select query_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
