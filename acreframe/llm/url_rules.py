"""URL filters: pattern rules found by their rarest literal token, so a URL runs the regular expressions of few rules only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import free_name

#: Characters of rule patterns that a pass over the URLs holds; more rules take more passes.
RULE_CHARS = 8 << 20

_TOKEN = re.compile("[0-9a-z]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


class Rule(NamedTuple):
    """A rule: its name, its action (allow or block), its pattern, and whether it is a site's own rule (the longest of these decides)."""

    name: str
    action: str
    pattern: str
    site: bool


def site_rule(action: str, place: str) -> Rule:
    """The rule of `place`, a host followed by a path: it fits the host and its subdomains where the path starts so."""
    host, _, path = place.partition("/")
    return Rule(place, action, f"||{host.translate(_FOLD)}/{path}", True)


def pattern_rule(line: str) -> Rule:
    """A line of a filter list: a pattern to block, or behind `@@` one to allow.

    A pattern is looked for anywhere in host and path.  `||` at its start stands for the start of the host or of a label of it, `|` at its start
    or end for that of the URL, `*` for any characters, `^` for one that is neither letter, digit nor any of `_-.%`, or for the end.
    """
    return Rule(line, "allow", line[2:], False) if line.startswith("@@") else Rule(line, "block", line, False)


def _parts(pattern: str) -> tuple[str, str, str]:
    """The anchor at the start, what stands between, and the anchor at the end."""
    start = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    pattern = pattern[len(start) :]
    return (start, pattern[:-1], "|") if pattern.endswith("|") else (start, pattern, "")


def expression(rule: Rule) -> str:
    """The regular expression that is searched for in host and path."""
    start, body, end = _parts(rule.pattern)
    begins = {"||": r"\A(?:[^/]*\.)?", "|": r"\A", "": ""}[start]
    made = {"*": r"(?s:.*)", "^": r"(?:[^0-9A-Za-z_\-.%]|\Z)"}
    escaped = "".join(made.get(c) or (c if c.isalnum() or ord(c) > 127 else rf"\{c}") for c in body)
    return begins + escaped + (r"\Z" if end else "")


def literal_tokens(rule: Rule) -> set[str]:
    """The runs of letters and digits that stand whole in whatever the pattern fits: both their ends are sure to be those of a run."""
    start, body, end = _parts(rule.pattern)
    body = body.translate(_FOLD)
    out = set()
    for m in _TOKEN.finditer(body):
        left = bool(start) if m.start() == 0 else body[m.start() - 1] != "*"
        right = bool(end) if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            out.add(m[0])
    return out


def host_of(url: Column) -> Column:
    """Behind the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to `?`, `#` or the end; empty where there is no `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _blocks(rules: list[Rule]) -> Iterator[list[Rule]]:
    held, size = [], 0
    for rule in rules:
        if held and size + len(rule.pattern) > RULE_CHARS:
            yield held
            held, size = [], 0
        held.append(rule)
        size += len(rule.pattern)
    if held:
        yield held


def token_counts(places: DataFrame, host: str, path: str, tokens: set[str]) -> dict[str, int]:
    """In how many rows each of the tokens stands; added up in each task, and as many rows as tokens come back."""
    names = sorted(tokens)
    number = places.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(number.value), np.int64)
        for batch in batches:
            for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for t in set(_TOKEN.findall(f"{h}{p}".translate(_FOLD))):
                    at = number.value.get(t)
                    if at is not None:
                        total[at] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(total[found])], names=["token", "n"])

    found = places.select(host, path).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = dict.fromkeys(names, 0) | {names[r.token]: r.n for r in found}
    number.unpersist()
    return counts


def rule_index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Under each token the rules of which it is the rarest, by number; under "" those without a whole token, which every URL runs."""
    index: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        index.setdefault(min(literal_tokens(rule), key=lambda t: (counts[t], t), default=""), []).append(i)
    return index


def _weight(rule: Rule) -> tuple[bool, int, bool, str]:
    """What decides among rules that fit: a site's own rule, the longest; then a pattern that allows; then by name."""
    return rule.site, len(rule.name) if rule.site else 0, rule.action == "allow", rule.name


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """pages, all rows and columns, with host, path, rule (the site's rule that decides, else null), pattern (the pattern that decides, where no
    site's rule fits), verdict (allow or block; allow where nothing fits) and tried (how many regular expressions the URL ran).

    Columns of these names are replaced.  A null url, or one without `://`, has an empty host and path, which patterns may fit; repeated rows fare
    alike.  Among sites' rules that fit the longest decides, among patterns one that allows.  No row is shuffled: rules are sent to the tasks,
    RULE_CHARS to a pass, and the best rule of each pass is held against that of those before.
    """
    own = ("host", "path", "rule", "pattern", "verdict", "tried")
    kept = [c for c in pages.columns if c.lower() not in own]
    host, path, name, action, site, tried = columns = tuple(free_name(pages, f"__{c}") for c in ("host", "path", "name", "action", "site", "tried"))
    placed = pages.withColumns({host: host_of(F.col("url")), path: path_of(F.col("url"))}).select(*[F.col(f"`{c}`") for c in kept], host, path)
    nothing = F.lit(None).cast("string")
    out = placed.withColumns({name: nothing, action: nothing, site: F.lit(None).cast("boolean"), tried: F.lit(0).cast("long")})
    for block in _blocks(rules):
        counts = token_counts(placed, host, path, set().union(*map(literal_tokens, block)))
        out = out.mapInArrow(_matcher(out, block, rule_index(block, counts), columns), out.schema)
    deciding = {"host": F.col(host), "path": F.col(path), "rule": F.when(F.col(site), F.col(name)), "pattern": F.when(~F.col(site), F.col(name)), "verdict": F.coalesce(action, F.lit("allow")), "tried": F.col(tried)}
    return out.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for n, c in deciding.items()])


def _matcher(df: DataFrame, rules: list[Rule], index: dict[str, list[int]], columns: tuple[str, ...]):
    """A pass: the URLs of a batch, each distinct one once, fetch rules by their tokens and run only these."""
    held = df.sparkSession.sparkContext.broadcast((rules, index))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, index = held.value
        made: dict[int, re.Pattern] = {}

        def judge(target: str) -> tuple[Rule | None, int]:
            found, many = None, 0
            for token in {"", *_TOKEN.findall(target.translate(_FOLD))}:
                for i in index.get(token, ()):
                    many += 1
                    if i not in made:
                        made[i] = re.compile(expression(rules[i]))
                    if made[i].search(target) and (found is None or _weight(rules[i]) > _weight(found)):
                        found = rules[i]
            return found, many

        for batch in batches:
            part = {c: batch.column(names.index(c)) for c in columns}
            hosts, paths, *before, tried = (part[c].to_pylist() for c in columns)
            targets = [h + p for h, p in zip(hosts, paths, strict=True)]
            known = {t: judge(t) for t in set(targets)}
            best = [None if n is None else Rule(n, a, "", s) for n, a, s in zip(*before, strict=True)]
            best = [max((r for r in (b, known[t][0]) if r), key=_weight, default=None) for b, t in zip(best, targets, strict=True)]
            new = [[r and r.name for r in best], [r and r.action for r in best], [r and r.site for r in best], [n + known[t][1] for n, t in zip(tried, targets, strict=True)]]
            part |= {c: pa.array(x, batch.schema.field(c).type) for c, x in zip(columns[2:], new, strict=True)}
            yield pa.RecordBatch.from_arrays([part.get(c, batch.column(i)) for i, c in enumerate(names)], names=names)

    return run


#: The rules of query op11_url_rules; its SQL states the same ones.
SITES = [site_rule("allow", "org/"), site_rule("block", "example.org/es/"), site_rule("block", "example.org/en/1"), site_rule("allow", "com/fr/"), site_rule("block", "com/de/")]
PATTERNS = [pattern_rule(x) for x in ("||casino-win.", "||free-bets.", "||cheap-pills.", "||ads-track.", "||tionsh.*/*7/|", "/en/*00.html|", "@@||blog.*.html|", "-*-")]

URL_SQL = r"""
with placed as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), ruled as (
  select *, case
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
      when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
  from placed
)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when regexp_matches(host || path, '\A([^/]*\.)?blog\.(?s:.*)\.html\z') then 'allow'
    when regexp_matches(host || path, '\A([^/]*\.)?(casino-win|free-bets|cheap-pills|ads-track)\.') then 'block'
    when regexp_matches(host || path, '\A([^/]*\.)?tionsh\.(?s:.*)/(?s:.*)7/\z') then 'block'
    when regexp_matches(host || path, '/en/(?s:.*)00\.html\z') then 'block'
    when regexp_matches(host || path, '-(?s:.*)-') then 'block'
    else 'allow' end as verdict
from ruled
"""
