"""DuckDB SQL of the numbered operators that SQL can express."""

from __future__ import annotations


def collocations(least: int = 30, top: int = 2000, absorbed_percent: int = 80) -> str:
    """All stretches of 1 to 4 words of a piece, counted, then scores and the report."""
    grams = " union all ".join(
        f"select lang, {k} as k, array_to_string(ws[p:p + {k - 1}], ' ') as phrase "
        f"from (select lang, ws, unnest(range(1, len(ws) - {k - 2})) as p from pieces)" for k in range(1, 5))
    return f"""
with pieces as materialized (
  select lang, list_filter(regexp_split_to_array(part, '[\\x20\\x09]+'), lambda w: w <> '') as ws
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\\x0A-\\x0D]')) as part from documents)),
totals as (select lang, sum(len(ws))::bigint as n from pieces group by lang),
grams as materialized (select lang, k, phrase, count(*) as n from ({grams}) group by all having count(*) >= {least}),
listed as materialized (select *, string_split(phrase, ' ') as ws from grams where k > 1),
parted as (
  select *, array_to_string(ws[1:cut], ' ') as first, array_to_string(ws[cut + 1:], ' ') as rest
  from (select *, unnest(range(1, k)) as cut from listed)),
cuts as (
  select g.lang, g.phrase, g.n as a, l.n as l, r.n as r, g.cut,
         cast(2000000::hugeint * g.n // (l.n::hugeint + r.n) as bigint) as score
  from parted g join grams l on l.lang = g.lang and l.phrase = g.first
  join grams r on r.lang = g.lang and r.phrase = g.rest),
least_cut as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
  select lang, array_to_string(ws[p:p + m - 1], ' ') as phrase, max(n) as longer
  from (select *, unnest(range(1, k - m + 2)) as p from (select *, unnest(range(2, k)) as m from listed))
  group by 1, 2),
kept as (
  select c.* from least_cut c left join inside i on i.lang = c.lang and i.phrase = c.phrase
  where i.longer is null or 100::hugeint * i.longer < {absorbed_percent}::hugeint * c.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
from ranked r join totals t on t.lang = r.lang where r.rank <= {top}"""
