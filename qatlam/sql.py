"""DuckDB expressions for the oracle queries, written for its regular expressions (no look-around, ASCII classes)."""

from __future__ import annotations

from qatlam.functions import quality as Q
from qatlam.functions import text as T
from qatlam.functions import urls as U


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rep(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def strip(x: str) -> str:
    return rep(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$")


#: Placeholders for е and Е read as ye: they still are vowels to their neighbours.
_YE = {"\ue000": "ye", "\ue001": "Ye"}


def _latin_word(w: str) -> str:
    small, big = _YE
    v = T.VOWELS + T.VOWELS.upper() + small + big
    x = w
    for c, t in (("ц", "ts"), ("Ц", "Ts")):
        x = rep(x, f"^{c}", t)
        for _ in range(2):
            x = rep(x, f"([{v}]){c}([{v}])", rf"\1{t}\2")
    x = rep(rep(x, "^е", small), "^Е", big)
    for _ in range(2):
        x = rep(rep(x, f"([{v}])е", rf"\1{small}"), f"([{v}])Е", rf"\1{big}")
    letters = T.CYRILLIC | {"е": "e", "ц": "s"}
    letters |= {k.upper(): s[:1].upper() + s[1:] for k, s in letters.items()}
    letters |= _YE
    one = {k: s for k, s in letters.items() if len(s) == 1}
    for k, s in letters.items():
        if len(s) != 1:
            x = f"replace({x}, {q(k)}, {q(s)})"
    return f"translate({x}, {q(''.join(one))}, {q(''.join(one.values()))})"


def to_latin(x: str) -> str:
    word = f"[{T.WORD_LETTERS}]+|[^{T.WORD_LETTERS}]+"
    return f"""array_to_string(list_transform(regexp_extract_all({x}, {q(word)}), lambda w:
      CASE WHEN NOT regexp_matches(w, '[а-яА-ЯёЁўЎқҚғҒҳҲ]') THEN w
           WHEN NOT regexp_matches(w, '[a-zа-яёўқғҳ]') THEN upper({_latin_word('lower(w)')})
           ELSE {_latin_word('w')} END), '')"""


def good_token(t: str) -> str:
    bad = r"[^\p{L}\p{Nd}'\-.,!?:;()\"«»–—…]"
    return f"""(NOT regexp_matches({t}, {q(bad)}) AND NOT regexp_matches({t}, '^\\p{{L}}$') AND NOT
      (regexp_matches({t}, '\\p{{Nd}}') AND regexp_matches({t}, '\\p{{L}}') AND NOT regexp_matches({t}, '^\\p{{Nd}}+-\\p{{L}}+[.,!?:;]*$')
       AND NOT regexp_matches({t}, '^\\p{{L}}+-\\p{{Nd}}+[.,!?:;]*$')))"""


def strip_line(line: str) -> str:
    return f"""CASE WHEN regexp_matches({line}, '[^\\s\\p{{Z}}]')
      THEN array_to_string(list_filter(string_split_regex({line}, '[\\s\\p{{Z}}]+'), lambda t: t <> '' AND {good_token('t')}), ' ') ELSE {line} END"""


def strip_garbage(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: {strip_line('l')}), chr(10))"


def normalized(x: str) -> str:
    links = "|".join(T.WIKI_EDIT)
    x = rep(x, rf"(?i)\[\s*(?:{links})(?:\s*\|\s*(?:{links}))*\s*\]")
    x = rep(rep(x, f"[{T.INVISIBLE}]"), "[–—]", "-")
    x = rep(x, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", r"\1\2")
    x = rep(rep(x, f"[{T.APOSTROPHES}]", "'"), f"[{T.QUOTES}]", '"')
    x = rep(rep(x, r"[ \t]+", " "), r" \n", "\n")
    return strip(rep(x, r"\n{3,}", "\n\n"))


def dedup_form(x: str) -> str:
    return rep(strip(f"lower({x})"), r"[\s\p{Z}]+", " ")


def repeat_form(x: str) -> str:
    return f"lower({strip(rep(rep(x, chr(92) + 'p{Nd}+'), '[' + chr(92) + 's' + chr(92) + 'p{Z}]+', ' '))})"


def is_page_number(x: str) -> str:
    return f"regexp_matches({strip(x)}, {q(T.PAGE_NUMBER)})"


def is_byline(x: str) -> str:
    return f"regexp_matches({strip(x)}, {q(T.BYLINE)})"


def denoised_line(line: str) -> str:
    return f"CASE WHEN {is_page_number(line)} OR {is_byline(line)} THEN '' ELSE {strip_line(line)} END"


def language_score(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '[a-z'']+')"
    stops = ", ".join(q(w) for w in Q.STOPWORDS)
    ends = "^.{2,}(" + "|".join(Q.SUFFIXES) + ")$"
    return f"""CASE WHEN len({words}) = 0 THEN 0.0 ELSE least(1.0, (len(list_filter({words}, lambda w: w IN ({stops})))
      + len(list_filter({words}, lambda w: regexp_matches(w, '[og]'''))) + len(list_filter({words}, lambda w: regexp_matches(w, {q(ends)})))) / len({words})) END"""


def quality_reason(x: str) -> str:
    t = Q.Thresholds()
    dense = rep(x, r"[\s\p{Z}]+")
    n = f"greatest(length({dense}), 1)"
    letters = f"length({rep(dense, '[^' + chr(92) + 'p{L}]+')})"
    upper = f"length({rep(dense, '[^' + chr(92) + 'p{Lu}]+')})"
    words = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]+')"
    lower = f"list_transform({words}, lambda w: lower(w))"
    mixed = r"[A-Za-z][\p{L}\p{Nl}\p{No}]*[Ѐ-ӿ]|[Ѐ-ӿ][\p{L}\p{Nl}\p{No}]*[A-Za-z]"
    urls = f"coalesce(list_sum(list_transform(regexp_extract_all({x}, {q(Q.URLISH)}), lambda u: length(u))), 0)"
    most = f"list_max(list_transform(list_distinct({lower}), lambda w: len(list_filter({lower}, lambda v: v = w))))"
    return f"""CASE WHEN length({strip(x)}) < {t.min_chars} THEN 'juda_qisqa' WHEN len({words}) < {t.min_words} THEN 'soz_kam'
      WHEN (length({dense}) - {letters}) / {n} > {t.max_symbol_ratio} THEN 'simvol_kop' WHEN regexp_matches({x}, {q(mixed)}) THEN 'aralash_alifbo'
      WHEN {upper} / greatest({letters}, 1) > {t.max_upper_ratio} THEN 'katta_harf_kop' WHEN {urls} / {n} > {t.max_url_ratio} THEN 'url_kop'
      WHEN {most} / len({words}) > {t.max_repeat_ratio} THEN 'ortiqcha_takror' END"""


def marks(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[,;]'))"


def structure_reason(x: str, page: str, repeated: str) -> str:
    s = strip(x)
    return f"""CASE WHEN {is_page_number(x)} THEN 'sahifa_raqami' WHEN {repeated} THEN 'kolontitul'
      WHEN regexp_matches({s}, '\\.{{3,}}\\s*[0-9]{{1,4}}\\s*$') THEN 'mundarija'
      WHEN {page} <= 3 AND regexp_matches(lower({s}), {q('|'.join(Q.FRONT_MATTER))}) THEN 'front_matter'
      WHEN {marks(s)} >= 3 AND regexp_matches({s}, '(19|20)[0-9]{{2}}') THEN 'bibliografiya' END"""


FUNNEL = f"""
WITH f AS (SELECT path, form FROM (SELECT path, page, {repeat_form('text')} AS form FROM blocks) WHERE form <> '' AND length(form) < 100
           GROUP BY path, form HAVING count(DISTINCT page) >= 3),
s AS (SELECT b.*, {structure_reason('b.text', 'b.page', 'f.form IS NOT NULL')} AS structure_reason
      FROM (SELECT block_id, path, block_idx, page, coalesce(text, '') AS text, {repeat_form("coalesce(text, '')")} AS form FROM blocks) b LEFT JOIN f USING (path, form)),
l AS (SELECT *, {to_latin('text')} AS lat0 FROM s),
g AS (SELECT *, {strip_garbage('lat0')} AS latin FROM l),
r AS (SELECT *, coalesce(structure_reason, CASE WHEN {language_score('latin')} < 0.20 THEN 'til_ozbekcha_emas' END, {quality_reason('latin')}) AS r0,
      {normalized('latin')} AS clean_text FROM g),
n AS (SELECT *, coalesce(r0, CASE WHEN clean_text = '' THEN 'normalizatsiyadan_song_bosh' END) AS r1 FROM r),
k AS (SELECT *, CASE WHEN r1 IS NULL THEN sha1({dedup_form('clean_text')}) END AS key FROM n),
funnel AS (SELECT block_id, path, block_idx, page, clean_text,
      coalesce(r1, CASE WHEN row_number() OVER (PARTITION BY key ORDER BY path, block_idx) > 1 THEN 'takror' END) AS drop_reason FROM k)
"""

_URL = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\s]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def url_part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {q(_URL)}, {i})"


def bare_host(u: str) -> str:
    return rep(rep(rep(f"lower({url_part(u, 2)})", "^.*@"), ":[0-9]*$"), r"\.+$")


def host_key(u: str) -> str:
    return rep(bare_host(u), r"^www\.")


def canonical(u: str) -> str:
    scheme, h = f"lower({url_part(u, 1)})", bare_host(u)
    port = f"regexp_extract(lower({url_part(u, 2)}), ':([0-9]+)$', 1)"
    path0 = rep(url_part(u, 3), "/{2,}", "/")
    path = f"CASE WHEN length({path0}) <= 1 THEN '/' ELSE {rep(path0, '/$')} END"
    tracking = ", ".join(q(x) for x in U.TRACKING)
    pairs = f"""list_sort(list_transform(list_filter(string_split({url_part(u, 4)}, '&'), lambda p: p <> '' AND lower(regexp_extract(p, '^([^=]*)', 1)) NOT IN ({tracking})
      AND NOT starts_with(lower(p), 'utm_')), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END))"""
    keep = f"{port} NOT IN ('', '0') AND NOT ({scheme} = 'http' AND {port} = '80') AND NOT ({scheme} = 'https' AND {port} = '443')"
    out = f"{scheme} || '://' || {h} || CASE WHEN {keep} THEN ':' || {port} ELSE '' END || {path} || CASE WHEN len({pairs}) > 0 THEN '?' || array_to_string({pairs}, '&') ELSE '' END"
    private = r"^(?:10|127|0)\.[0-9.]+$|^192\.168\.[0-9.]+$|^172\.(?:1[6-9]|2[0-9]|3[01])\.[0-9.]+$|^169\.254\.[0-9.]+$|^(?:24[0-9]|25[0-5])\.[0-9.]+$|^\[(?:::1?|f[cd].*|fe[89ab].*)\]$"
    return f"""CASE WHEN {scheme} IN ('http', 'https') AND {h} <> '' AND NOT contains({url_part(u, 2)}, '@') AND {h} <> 'localhost' AND NOT ends_with({h}, '.localhost')
      AND NOT regexp_matches({h}, {q(private)}) AND len({pairs}) <= 6 AND length({out}) <= 2048 THEN {out} END"""


def hinted(x: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({rep(f'lower({x})', '[' + T.APOSTROPHES[:5] + ']')}, {q('|'.join(h))}) THEN {q(c)}" for c, h in U.HINTS.items())
    return f"CASE {cases} END"


def category_from_url(u: str) -> str:
    return f"list_filter(list_transform(list_filter(string_split_regex(lower({url_part(u, 3)}), '[/_-]+'), lambda s: s <> ''), lambda s: {hinted('s')}), lambda c: c IS NOT NULL)[1]"
