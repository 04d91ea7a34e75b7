"""Quality rules: line-first cleaning.

Every line is judged on its own (navigation, symbols, shouting, stutter, boilerplate, repeats, missing punctuation); failing lines go,
and a document that loses too large a share of its words is rejected with the documents that fail the base rules.

Defined results: null and empty texts have no words, fail the base rule and are not kept; rows are judged one by one, so ties and
repeated rows get equal verdicts; an empty table gives an empty result; columns that clash with the new ones are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from . import common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_removed_words long, base_failed boolean, kept boolean, cleaned string"
)
#: Phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "we use cookies", "accept cookies",
    "enable javascript", "lorem ipsum", "click here", "subscribe to our newsletter", "share this", "read more", "sign in", "log in to", "back to top",
)
#: Words of menus, lower case, and signs that part their entries.
MENU = (
    "home", "news", "sport", "sports", "weather", "world", "about", "contact", "login", "logout", "register", "search", "sitemap", "help", "faq", "blog", "shop", "cart", "menu",
    "archive", "categories", "products", "services", "impressum", "kontakt", "datenschutz", "startseite", "accueil", "inicio", "contacto",
)
BARS = ("|", "·", "•", "›", "»", "→")
IN_MENU, BAR = frozenset(MENU), re.compile(f"[{''.join(BARS)}]")
#: A phrase is a whole one: no letter or digit stands beside it.
PHRASE = re.compile(f"(?:^|[^a-z0-9])(?:{'|'.join(BOILERPLATE)})(?:$|[^a-z0-9])")


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: A line with so large a share of words that are bars, or words of menus, or have symbols, or are in capitals fails.
    bar_percent: int = 20
    menu_percent: int = 70
    symbol_percent: int = 30
    capital_percent: int = 60
    #: Words that say the one before again.
    stutter_percent: int = 40
    #: Lines of at least so many words are tested for capitals and stutter; lines below so many words without a sentence end fail.
    capital_words: int = 4
    fragment_words: int = 5
    #: Documents that lose more than this share of their words are rejected.
    max_removed_percent: int = 50
    #: Lines of at most so many words are searched for phrases of page furniture: longer ones say more than the phrase.
    phrase_words: int = 24


def line_fails(line: str, words: list[str], r: Rules) -> bool:
    n = len(words)
    if BAR.search(line) and 100 * sum(map(words.count, BARS)) > r.bar_percent * n:
        return True
    if r.capital_words <= n <= r.phrase_words and 100 * sum(w.lower() in IN_MENU for w in words) > r.menu_percent * n:
        return True
    if SYMBOL.search(line) and 100 * sum(1 for w in words if SYMBOL.search(w)) > r.symbol_percent * n:
        return True
    if n >= r.capital_words and not line.islower() and 100 * sum(1 for w in words if w.isupper() and len(w) > 1) > r.capital_percent * n:
        return True
    if n >= r.capital_words and 100 * sum(map(str.__eq__, words, words[1:])) > r.stutter_percent * n:
        return True
    if n < r.fragment_words and not any(x in line for x in ".!?…。！？:"):
        return True
    return n <= r.phrase_words and PHRASE.search(line.lower()) is not None


def repeated(words: list[str], window: int) -> int:
    """Words that lie in a window that the text holds twice or more: windows get exact ids by doubling."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    width, spans = 1, {1: a}
    while width * 2 <= window:
        a = spans[width]
        if (m := len(a) - width) <= 0:
            return 0
        _, spans[width * 2] = np.unique(a[:m] * (int(a.max()) + 1) + a[width : width + m], return_inverse=True)
        width *= 2
    a, have = spans[width], width
    while have < window:
        step = max(k for k in spans if k <= window - have)
        m = n - have - step + 1
        _, a = np.unique(a[:m] * (int(spans[step].max()) + 1) + spans[step][have : have + m], return_inverse=True)
        have += step
    hit = np.bincount(a)[a] > 1
    if not hit.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.nonzero(hit)[0]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def judge(text: str | None, r: Rules) -> tuple:
    text = text or ""
    n = chars = dups = gone = 0
    seen: set[str] = set()
    keep, every = [], []
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            keep.append(line)
            continue
        n += len(words)
        chars += sum(map(len, words))
        every += words
        if line in seen:
            dups += 1
            gone += len(words)
            continue
        seen.add(line)
        if line_fails(line, words, r):
            gone += len(words)
        else:
            keep.append(line)
    rep = repeated(every, r.window)
    failed = n < r.min_words or 100 * rep > r.max_repeat_percent * n
    return n, chars, len(SYMBOL.findall(text)), dups, rep, gone, failed, not failed and 100 * gone <= r.max_removed_percent * n, "\n".join(keep)


def clean_lines(df: DataFrame, column: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``df`` with the counts, verdicts and cleaned text of FIELDS."""
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def make():
        return lambda texts: dict(zip(names, zip(*(judge(t, rules) for t in texts)), strict=True))

    return common.map_text(df, column, FIELDS, make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, their failing lines removed and n_chars counted anew."""
    from pyspark.sql import functions as F

    out = clean_lines(docs).where("kept")
    return out.select(*[F.col("cleaned").alias("text") if c == "text" else F.length("cleaned").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def _sql(r: Rules = Rules()) -> str:
    """The same in DuckDB, rule by rule."""
    word = r"[^\x20\x09-\x0D]+"
    bars, menu = (", ".join(f"'{x}'" for x in given) for given in (BARS, MENU))
    return rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as k from d),
lw as (select *, regexp_extract_all(line, '{word}') as w from l),
lf as (select *, len(w) as n, row_number() over (partition by doc_id, line order by k) > 1 as dup,
  100 * len(list_filter(w, lambda x: x in ({bars}))) > {r.bar_percent} * len(w)
  or len(w) between {r.capital_words} and {r.phrase_words} and 100 * len(list_filter(w, lambda x: lower(x) in ({menu}))) > {r.menu_percent} * len(w)
  or 100 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) > {r.symbol_percent} * len(w)
  or len(w) >= {r.capital_words} and 100 * len(list_filter(w, lambda x: length(x) > 1 and upper(x) = x and lower(x) <> x)) > {r.capital_percent} * len(w)
  or len(w) >= {r.capital_words} and 100 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > {r.stutter_percent} * len(w)
  or len(w) < {r.fragment_words} and not regexp_matches(line, '[.!?…。！？:]')
  or len(w) <= {r.phrase_words} and regexp_matches(lower(line), '{PHRASE.pattern}') as fails from lw where len(w) > 0),
per as (select doc_id, sum(n) as n_words, sum(list_sum(list_transform(w, lambda x: length(x)))) as word_chars, sum(dup::int) as n_dup_lines, sum(case when dup or fails then n else 0 end) as gone from lf group by doc_id),
ws as (select doc_id, regexp_extract_all(text, '{word}') as w from d),
g as (select doc_id, i, array_to_string(w[i:i + {r.window - 1}], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - {r.window - 2})) as i from ws where len(w) > {r.window})),
rep as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + {r.window})) as j from (select doc_id, i, count(*) over (partition by doc_id, s) as c from g) where c > 1) group by doc_id),
f as (select d.doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars, cast(len(regexp_extract_all(d.text, '[#*$%&|<>]')) as bigint) as n_symbols,
  cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words, cast(coalesce(gone, 0) as bigint) as n_removed_words
  from d left join per using (doc_id) left join rep using (doc_id)),
b as (select *, n_words < {r.min_words} or 100 * n_repeat_words > {r.max_repeat_percent} * n_words as base_failed from f)
select *, not base_failed and 100 * n_removed_words <= {r.max_removed_percent} * n_words as kept from b"""


SQL = _sql()
