"""DuckDB SQL that answers the p9_ and p10_ queries by plainer means.

Instead of resolving each token's script, every look-alike is brought to its Latin letter: two texts have
equal forms there exactly if they have here. Joiners within emoji sequences, which only the operator keeps, go too.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from marlstone.llm.leakage import LENGTH, WITHIN
from marlstone.llm.lookalike import LOOKALIKES, folds


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _translate(x: str, table: dict[str, str]) -> str:
    """Characters to characters; those that go to nothing stand last, as translate drops what has no counterpart."""
    pairs = sorted(table.items(), key=lambda p: p[1] == "")
    return f"translate({x}, {_quote(''.join(a for a, _ in pairs))}, {_quote(''.join(b for _, b in pairs))})"


@cache
def _letters() -> dict[str, str]:
    """Every look-alike, bare or composed with marks, and its Latin letter with them."""
    bare = {c: row[0] for row in LOOKALIKES for c in row[1:]}
    out = dict(bare)
    for cp in range(0x80, 0x20000):
        parts = unicodedata.normalize("NFD", chr(cp))
        if len(parts) > 1 and parts[0] in bare:
            to = unicodedata.normalize("NFC", bare[parts[0]] + parts[1:])
            if len(to) == 1:
                out[chr(cp)] = to
    return out


@cache
def plain(x: str) -> str:
    """Folded and composed, letters as they are."""
    table = {chr(c): to or "" for c, to in folds().items()}
    for a, b in table.items():
        if len(b) > 1:
            x = f"replace({x}, {_quote(a)}, {_quote(b)})"
    return f"nfc_normalize({_translate(x, {a: b for a, b in table.items() if len(b) < 2})})"


def form(x: str) -> str:
    return f"nfc_normalize({_translate(plain(x), _letters())})"


_FORMS = f"forms as (select doc_id, text, {form('text')} form from documents where text is not null), kept as (select * from forms where trim(regexp_replace(form, '\\s+', ' ', 'g')) <> '')"

_TOKENS = f"regexp_extract_all({plain('text')}, '[\\p{{L}}\\p{{M}}]+')"
_SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Lisu", "Coptic")
_USED = " + ".join(f"regexp_matches(t, '\\p{{{s}}}')::int" for s in _SCRIPTS)
_DOUBLE = "".join(sorted(set(_letters()) | {row[0] for row in LOOKALIKES}))


def _words(x: str) -> str:
    return f"regexp_extract_all(replace(lower({form(x)}), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+')"


_SHARED = f"""
 d as (select doc_id, {_words('text')} w from documents where text is not null),
 h as (select item_id, {_words('text')} w from heldout_items where text is not null),
 dg as (select doc_id, unnest(generate_series(1, len(w) - {LENGTH - 1})) p, w from d where len(w) >= {LENGTH}),
 hg as (select item_id, unnest(generate_series(1, len(w) - {LENGTH - 1})) s, w from h where len(w) >= {LENGTH}),
 hits as (select distinct doc_id, item_id, p - s shift, s from (select doc_id, p, array_to_string(w[p:p + {LENGTH - 1}], ' ') g from dg) x
   join (select item_id, s, array_to_string(w[s:s + {LENGTH - 1}], ' ') g from hg) y using (g))
"""

SQL = {
    "p9_found": f"with {_SHARED.strip()} select distinct doc_id, item_id from hits",
    "p9_evidence": f"""with {_SHARED.strip()},
 isles as (select *, s - row_number() over (partition by doc_id, item_id, shift order by s) isle from hits)
select distinct doc_id, item_id, (min(s) - 1)::int as item_from, (min(s) - 1 + shift)::int as doc_from, (max(s) - min(s) + {LENGTH})::int as words from isles group by doc_id, item_id, shift, isle""",
    "p9_proximity": f"""with d as (select doc_id, {_words('text')} w from documents where text is not null),
 h as (select item_id, {_words('text')} w from heldout_items where text is not null),
 terms as (select distinct item_id, unnest(w) t from h),
 placed as (select doc_id, unnest(w) t, generate_subscripts(w, 1) p from d),
 often as (select t, count(*) n from placed where t in (select t from terms) group by t),
 ranked as (select item_id, t, coalesce(n, 0) n, row_number() over (partition by item_id order by coalesce(n, 0), encode(t)) k from terms left join often using (t)),
 few as (select item_id, k, t from ranked where k <= 3 and item_id in (select item_id from ranked where k <= 3 group by item_id having count(*) = 3 and min(n) > 0)),
 q as (select item_id, k, doc_id, p from few join placed using (t))
select doc_id, item_id, min(greatest(a.p, b.p, c.p) - least(a.p, b.p, c.p) + 1)::int as span
from (select * from q where k = 1) a join (select * from q where k = 2) b using (item_id, doc_id) join (select * from q where k = 3) c using (item_id, doc_id)
where greatest(a.p, b.p, c.p) - least(a.p, b.p, c.p) < {WITHIN} group by 1, 2""",
    "p10_found": f"with {_FORMS} select a.doc_id as doc_id_a, b.doc_id as doc_id_b from kept a join kept b on a.form = b.form and a.doc_id < b.doc_id and a.text <> b.text",
    "p10_classes": f"""with {_FORMS},
 groups as (select form, min(doc_id) as class, count(distinct text) as spellings from kept group by form),
 toks as (select doc_id, unnest({_TOKENS}) t from kept),
 kinds as (select doc_id, count(*) filter (used > 1 and seen) mixed, count(*) filter (used = 1 and not latin and double) whole from (
   select doc_id, {_USED} used, regexp_matches(t, '[{_DOUBLE}]') seen, regexp_matches(t, '\\p{{Latin}}') latin, regexp_full_match(t, '[{_DOUBLE}\\p{{M}}]+') double from toks) group by 1)
select kept.doc_id, class, spellings, coalesce(mixed, 0) as mixed, coalesce(whole, 0) as whole from kept join groups using (form) left join kinds using (doc_id)""",
}
