"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import op5_chat_format
from .ctxmix import op4_lm_score
from .dartmin import op9_minhash_dedup
from .decontam import op3_decontaminate
from .langid import op10_language_id
from .mixing import op2_mix_sources
from .substring import op1_substring_dedup
from .syncmer import op7_syncmer_fingerprint
from .toxicity import op6_toxicity
from .urlfilter import op8_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_decontaminate": op3_decontaminate,
    "op4_lm_score": op4_lm_score,
    "op5_chat_format": op5_chat_format,
    "op6_toxicity": op6_toxicity,
    "op7_syncmer_fingerprint": op7_syncmer_fingerprint,
    "op8_url_filter": op8_url_filter,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_language_id": op10_language_id,
}

_WORDS = r"w as (select doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents)"

#: Windows, the least document of each, the words they cover, and what is left.
_SUBSTRING = f"""with {_WORDS}, win as (select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as k from w, unnest(range(1, len(ws) - 48)) as t(i)),
least as (select k, min(doc_id) as home from win group by 1), hit as (select doc_id, i from win join least using (k) where home < doc_id),
gone as (select doc_id, list(distinct j) as js from (select doc_id, unnest(range(i, i + 50)) as j from hit) group by 1),
kept as (select w.doc_id, len(ws) as n_words, coalesce(len(js), 0) as n_removed, list_filter(ws, lambda x, i: js is null or not list_contains(js, i)) as left_ from w left join gone on gone.doc_id = w.doc_id)
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed, sha256(array_to_string(left_, ' ')) as kept_sha256 from kept"""

#: All pairs with a common shingle, exact weighted Jaccard, and the closure of the links.
_NEAR = f"""with recursive {_WORDS}, sh as (select doc_id, g, count(*) as n from (select doc_id, unnest(case when len(ws) >= 5 then [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g from w) group by 1, 2),
tot as (select doc_id, sum(n) as t from sh group by 1), pr as (select a.doc_id as x, b.doc_id as y, sum(least(a.n, b.n)) as s from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select x, y from pr join tot a on a.doc_id = x join tot b on b.doc_id = y where s >= 0.8 * (a.t + b.t - s) - 1e-9),
r(id, lab) as (select doc_id, doc_id from documents union select r.id, e.y from r join e on e.x = r.lab),
c as (select id as doc_id, min(lab) as class_id from r group by 1) select doc_id, class_id, count(*) over (partition by class_id) as n_class from c"""

_CONTROLS = [r"\[\\*INST\]", r"\[\\*/INST\]", r"<\\*s>", r"<\\*/s>", r"<\\*<SYS>>", r"<\\*</SYS>>", r"<\\*\|role\|>", r"<\\*\|text\|>", r"<\\*\|end\|>"]
_ESCAPES = " + ".join(f"len(regexp_extract_all(text, '{c}'))" for c in _CONTROLS)
#: Roles other than the three of the template do not occur in the table.
_CHAT = f"""with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256, cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256, cast(sum(length(text) + {_ESCAPES} + case role when 'user' then 13 when 'assistant' then 7 else 15 end) as bigint) as formatted_chars from t group by 1"""

#: The other operators rest on learned models, hashes or running roundings that SQL does not have; the tests hold them against brute force.
SQL: dict[str, str] = {"op1_substring_dedup": _SUBSTRING, "op5_chat_format": _CHAT, "op9_minhash_dedup": _NEAR}
