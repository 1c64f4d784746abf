"""Sources and sinks: lenient text tables, shards, marked-up texts, archives, manifests, exports."""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import json
import re
import time
import uuid
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources.tables import shared_folder

NULL_TOKEN = "\\N"


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder (see ``tables.shared_folder``), seen by all executors."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def scan_csv_text(spark: SparkSession, path: str, columns: list[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """Every column a text, empty text kept apart from null."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    r = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote).option("nullValue", NULL_TOKEN).option("emptyValue", "")
    return r.option("escape", '"').option("multiLine", False).csv(path)


def scan_tsv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Tab-separated without quoting; contract columns that are absent come as empty texts, in the contract's order."""
    raw = spark.read.option("header", True).option("sep", "\t").option("quote", "").option("nullValue", NULL_TOKEN).option("emptyValue", "").csv(path)
    return raw.select(*[(F.coalesce(F.col(f), F.lit("")) if f in raw.columns else F.lit("")).alias(f) for f in fields])


def ingest(df: DataFrame, path: str, tag: str) -> None:
    """Rows as text columns with a slice tag, to zstd Parquet."""
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.lit(tag).alias("slice_tag")).write.mode("append").option("compression", "zstd").parquet(path)


def semi_filter(bulk: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the bulk whose key is wanted, and the wanted keys without a row."""
    k = keys.select(key).distinct()
    return bulk.join(k, key, "left_semi"), k.join(bulk.select(key), key, "left_anti")


def scan_shards(spark: SparkSession, paths: list[str], contract: dict[str, str]) -> DataFrame:
    """All shards aligned to a contract with the name of the shard; no paths give an empty typed frame."""
    schema = ", ".join(f"`{c}` {t}" for c, t in contract.items())
    if not paths:
        return spark.createDataFrame([], schema + ", shard string")
    return spark.read.schema(schema).parquet(*paths).withColumn("shard", F.element_at(F.split(F.input_file_name(), "/"), -1))


def dimension_frame(spark: SparkSession, rows: list[dict], key: str) -> DataFrame:
    """A configured list as a frame; repeated keys are an error."""
    seen = [r[key] for r in rows]
    if len(set(seen)) != len(seen):
        raise ValueError(f"repeated {key} in a configured list")
    cols = sorted({c for r in rows for c in r})
    return spark.createDataFrame([[None if r.get(c) is None else str(r[c]) for c in cols] for r in rows], ", ".join(f"{c} string" for c in cols))


def xml_text(c: Column) -> Column:
    """Character data with its entities resolved: the five of XML, and decimal and hexadecimal references. ``&amp;`` last, so nothing is resolved twice."""
    numbered = F.split(F.regexp_replace(c, "&#(x[0-9A-Fa-f]{1,6}|[0-9]{1,7});", "\x01$1\x02"), "[\x01\x02]", -1)

    def sign(x: Column, i: Column) -> Column:
        code = F.when(x.startswith("x"), F.conv(F.substring(x, 2, 8), 16, 10)).otherwise(x).try_cast("int")
        return F.when(i % 2 == 1, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(x)

    s = F.when(c.contains("&#"), F.array_join(F.transform(numbered, sign), "")).otherwise(c)
    for name, ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        s = F.replace(s, F.lit(f"&{name};"), F.lit(ch))
    return s


def xml_escape(c: Column) -> Column:
    """A text as character data or attribute value."""
    for ch, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        c = F.replace(c, F.lit(ch), F.lit(f"&{name};"))
    return c


def xml_to_eav(df: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, attr_key, value, units) of ``<Attribute attribute_name=".." unit="..">..</Attribute>`` and ``<TAG>/<VALUE>/<UNITS>`` elements.

    XML attributes may stand in any order and in either kind of quotes; entities and CDATA sections are resolved; an empty element has an empty
    value. Texts without such elements, and null, give no rows.
    """
    text = F.regexp_replace(F.col(xml), r"(?s)<!--.*?-->", "")
    one = F.regexp_extract_all(text, F.lit(r"(?s)(<Attribute\b[^>]*?/>|<Attribute\b[^>]*>.*?</Attribute>)"), F.lit(1))
    two = F.regexp_extract_all(text, F.lit(r"(?s)(<TAG>.*?</TAG>\s*(?:<VALUE>.*?</VALUE>|<VALUE\s*/>)?(?:\s*<UNITS>.*?</UNITS>)?)"), F.lit(1))
    named = lambda e, n: F.regexp_replace(F.regexp_extract(e, rf"(?s)^<Attribute\b[^>]*?\s{n}\s*=\s*(\"[^\"]*\"|'[^']*')", 1), "^.|.$", "")
    inner = lambda e, n: F.regexp_extract(e, rf"(?s)<{n}(?:\s[^>]*)?>(.*?)</{n}>", 1)
    plain = lambda x: F.when(x.startswith("<![CDATA["), F.regexp_replace(x, r"(?s)^<!\[CDATA\[|\]\]>$", "")).otherwise(xml_text(x))
    a = F.transform(one, lambda e: F.struct(named(e, "attribute_name").alias("k"), inner(e, "Attribute").alias("v"), named(e, "unit").alias("u")))
    b = F.transform(two, lambda e: F.struct(inner(e, "TAG").alias("k"), inner(e, "VALUE").alias("v"), inner(e, "UNITS").alias("u")))
    x = df.where(F.col(xml).isNotNull()).select(key, F.explode(F.concat(a, b)).alias("x"))
    x = x.select(key, *[F.trim(plain(F.col(f"x.{c}"))).alias(n) for c, n in (("k", "attr_key"), ("v", "value"), ("u", "units"))])
    return x.withColumn("units", F.when(F.col("units") != "", F.col("units")))


def sections(c: Column, names: list[str]) -> dict[str, Column]:
    """Texts of the named parts of a marked-up article, tags removed and entities resolved; the rest of the body as ``other``.

    A part is an element of that name (``<abstract>``) or a section whose type, id or class begins with it, or whose title holds it as a word; the
    first such part counts. A missing part is an empty text.
    """
    bare = lambda x: F.trim(F.regexp_replace(xml_text(F.regexp_replace(x, "<[^>]+>", " ")), r"\s+", " "))
    out, rest = {}, c
    for n in names:
        open_ = rf"(?:<{n}\b[^>]*>|<sec(?:tion)?\b[^>]*\b(?:sec-type|id|class)\s*=\s*[\"']{n}[^>]*>|<sec(?:tion)?\b[^>]*>\s*<(?:title|h[1-6])>[^<]*\b{n}\b[^<]*</(?:title|h[1-6])>)"
        pattern = rf"(?is){open_}(.*?)</(?:{n}|sec|section)>"
        out[n] = bare(F.coalesce(F.regexp_extract(c, pattern, 1), F.lit("")))
        rest = F.regexp_replace(rest, pattern, " ")
    return out | {"other": bare(F.coalesce(rest, F.lit("")))}


def chunks(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, place, chunk): whole texts in pieces of at most ``size`` characters."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(size))
    return df.where(F.length(text) > 0).select(key, text, F.posexplode(starts).alias("place", "s")).select(key, "place", F.substring(F.col(text), F.col("s") + 1, F.lit(size)).alias("chunk"))


def parse_form(c: Column) -> Column:
    """A map from level-3 headings of a Markdown text to the text below; "no response" counts as empty."""
    bare = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    parts = F.filter(F.split(F.concat(F.lit("\n"), c), r"\n### "), lambda x: bare(x) != "")
    value = lambda x: bare(F.regexp_replace(x, r"^[^\n]*\n?", ""))
    entry = lambda x: F.struct(F.trim(F.substring_index(x, "\n", 1)).alias("k"), F.when(F.lower(value(x)).rlike("^_?no response_?$"), "").otherwise(value(x)).alias("v"))
    return F.map_from_entries(F.array_distinct(F.transform(parts, entry)))


def parse_report(lines: DataFrame, line: str) -> DataFrame:
    """(study, n, quoted): pipe-table rows and bullet lines that name a study and a candidate count."""
    s = F.col(line)
    study = F.regexp_extract(s, r"\b(PRJ[A-Z]{2}\d+)\b", 1)
    n = F.regexp_extract(s, r"(?:\|\s*|: )(\d+)(?:\s*\||\s+candidates)", 1)
    quoted = F.array_join(F.transform(F.regexp_extract_all(s, F.lit("`([^`]+)`"), F.lit(1)), lambda x: F.trim(x)), ";")
    return lines.where(s.rlike(r"^\s*[|*-].*\bPRJ[A-Z]{2}\d+")).select(study.alias("study"), F.when(n != "", n).try_cast("int").alias("n"), quoted.alias("quoted"))


def split_header(rows: list[list[str]]) -> tuple[list[str], list[list[str]]]:
    """Header and body of a raw table.

    The header is the row with most filled cells among the first ten (the first on a tie). All rows get the table's width; unnamed columns are
    called by their position, a name used before gets a number; rows without any filled cell are left out.
    """
    cells = pd.DataFrame([list(r) for r in rows]).map(lambda c: "" if c is None or c != c else str(c).strip()) if rows else pd.DataFrame()
    if cells.empty:
        return [], []
    head = int((cells.head(10) != "").sum(axis=1).to_numpy().argmax())
    raw = pd.Series([c or f"col{i}" for i, c in enumerate(cells.iloc[head], 1)])
    again = raw.groupby(raw).cumcount() + 1
    names = [n if k == 1 else f"{n}_{k}" for n, k in zip(raw, again)]
    body = cells.iloc[head + 1 :]
    return names, body[(body != "").any(axis=1)].to_numpy().tolist()


def _xlsx(data: bytes) -> dict[str, list[list[str]]]:
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    z = zipfile.ZipFile(io.BytesIO(data))
    texts = []
    if "xl/sharedStrings.xml" in z.namelist():
        texts = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
    out = {}
    for name in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
        rows = []
        for row in ET.fromstring(z.read(name)).iter(f"{{{ns['m']}}}row"):
            cells: dict[int, str] = {}
            for c in row.findall("m:c", ns):
                letters = re.match(r"[A-Z]+", c.get("r", "A"))[0]
                at = 0
                for ch in letters:
                    at = at * 26 + ord(ch) - 64
                v = c.find("m:v", ns)
                inline = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                cells[at - 1] = texts[int(v.text)] if c.get("t") == "s" and v is not None else (v.text if v is not None else inline)
            rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
        out[name.rsplit("/", 1)[1][:-4]] = rows
    return out


def _docx(data: bytes) -> dict[str, list[list[str]]]:
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    root = ET.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{w}t"))
    return {f"table{i + 1}": [[text(c) for c in r.findall(f"{w}tc")] for r in t.findall(f"{w}tr")] for i, t in enumerate(root.iter(f"{w}tbl"))}


def read_tables(data: bytes) -> dict[str, list[list[str]]]:
    """Tables of a file by sheet, the type told by its first bytes: workbook, document, or delimited text."""
    if data[:2] == b"PK":
        names = zipfile.ZipFile(io.BytesIO(data)).namelist()
        if "xl/workbook.xml" in names:
            return _xlsx(data)
        if "word/document.xml" in names:
            return _docx(data)
        return {}
    text = data.decode("utf-8-sig", errors="replace")
    first = text.split("\n", 1)[0]
    sep = max(["\t", ",", ";"], key=first.count)
    return {"table": list(csv.reader(io.StringIO(text), delimiter=sep))}


def walk_archive(path: str, data: bytes) -> Iterator[tuple[str, str, bytes]]:
    """(member path, status, bytes) of a file and, if it is a plain archive, of all members, nested archives of any depth included.

    Members are read one by one; a file that cannot be unpacked is ``broken``.
    """
    waiting = [(path, data)]
    while waiting:
        name, content = waiting.pop()
        try:
            plain = content[:2] == b"PK" and not read_tables(content)
            archive = zipfile.ZipFile(io.BytesIO(content)) if plain else None
        except Exception:  # noqa: BLE001  (no readable archive or office file)
            yield name, "broken", b""
            continue
        if archive is None:
            yield name, "read", content
            continue
        for m in archive.infolist():
            if m.is_dir():
                continue
            try:
                inner = archive.read(m)
            except Exception:  # noqa: BLE001
                yield f"{name}!{m.filename}", "broken", b""
                continue
            if inner[:2] == b"PK":
                waiting.append((f"{name}!{m.filename}", inner))
            else:
                yield f"{name}!{m.filename}", "read", inner


def parse_files(files: DataFrame) -> DataFrame:
    """(path, sheet, row_no, cells, status) of all tables in (path, content) rows, archives walked; one file is one task's work.

    ``cells`` is a JSON object by header. A file or member without a table gives one row with its status: ``empty``, ``broken`` or ``read``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for member, status, data in walk_archive(path, bytes(content)):
                    try:
                        tables = read_tables(data) if status == "read" else {}
                    except Exception:  # noqa: BLE001  (a broken member is a log line, not a failure)
                        tables, status = {}, "broken"
                    out = []
                    for sheet, rows in tables.items():
                        head, body = split_header(rows)
                        out += [(member, sheet, i, json.dumps(dict(zip(head, r))), status) for i, r in enumerate(body)]
                    yield pd.DataFrame(out or [(member, None, None, None, "empty" if status == "read" else status)], columns=["path", "sheet", "row_no", "cells", "status"])

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, row_no int, cells string, status string")


def file_rows(spark: SparkSession, glob: str) -> DataFrame:
    """``parse_files`` of the files of a folder."""
    return parse_files(spark.read.format("binaryFile").load(glob))


def sink(df: DataFrame, path: str, fmt: str, order: list[str]) -> None:
    """The frame as Parquet, CSV or JSON, ordered within range partitions; CSV keeps empty text apart from null."""
    w = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("nullValue", NULL_TOKEN).option("emptyValue", "").option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def sink_partitioned(df: DataFrame, path: str, key: str, max_records: int = 1_000_000) -> None:
    """One folder per key; rows are spread by key and a salt of bounded width, so a hot key is written by several tasks."""
    df.repartition(F.col(key), F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("overwrite").partitionBy(key).option("maxRecordsPerFile", max_records).parquet(path)


def sink_budget(df: DataFrame, path: str, budget: int, order: list[str]) -> None:
    """Files of at most ``budget`` bytes of JSON lines each (a longer single row has a file of its own), in the order of ``order``.

    Rows are laid end to end by their exact length: within each of the range-partitioned parts a running sum of bytes gives the file, and a file
    never spans two parts, so no task sees more than its part. One pass measures, one writes.
    """
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows = df.select(*order, line.alias("__line")).repartitionByRange(*order).sortWithinPartitions(*order)

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, file, used = TaskContext.get().partitionId(), 0, 0
        for pdf in batches:
            files = []
            for n in pdf["__line"].str.encode("utf-8").str.len() + 1:
                if used and used + n > budget:
                    file, used = file + 1, 0
                used += n
                files.append(f"{part:06d}-{file:06d}")
            yield pd.DataFrame({"__line": pdf["__line"], "part": files})

    out = rows.select("__line").mapInPandas(numbered, "__line string, part string")
    out.select(F.col("__line").alias("value"), "part").write.mode("overwrite").partitionBy("part").text(path)


def manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(file, bytes, sha256) of every file below a folder whose name fits a pattern, by its path from there; content is hashed where it lies."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return b.select(F.substring_index("path", f"/{name}/", -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def check_manifest(listed: DataFrame, now: DataFrame) -> DataFrame:
    """(file, problem): missing, changed or unlisted files."""
    a, b = listed.select("file", F.col("sha256").alias("__a")), now.select("file", F.col("sha256").alias("__b"))
    j = a.join(b, "file", "full_outer")
    p = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "unlisted").when(F.col("__a") != F.col("__b"), "changed")
    return j.select("file", p.alias("problem")).where("problem is not null")


def encode_payload(df: DataFrame, group: str, counts: list[str], means: list[str], scale: int = 1_000_000) -> DataFrame:
    """(group, payload): each group's rows as little-endian uint32: their number, then per row its counts and its means x ``scale``, rounded half up.

    Rows are ordered by their columns. Packed where they lie, from one array per group: groups are rows of a small aggregate each.
    """

    @F.pandas_udf("binary")
    def packed(rows: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([np.array([len(g), *[int(v) for r in g for v in r]], dtype="<u4").tobytes() for g in rows])

    whole = [F.col(c).cast("long") for c in counts] + [F.floor(F.col(c) * scale + 0.5).cast("long") for c in means]
    g = df.groupBy(group).agg(F.array_sort(F.collect_list(F.array(*whole))).alias("__r"))
    return g.select(group, packed("__r").alias("payload"))


def patiently(call: Callable, retries: int, wait: float):
    """The answer of ``call``, tried again up to ``retries`` times, each time after twice the wait; the last failure is raised."""
    for n in range(retries + 1):
        try:
            return call()
        except Exception:  # noqa: BLE001
            if n == retries:
                raise
            time.sleep(wait * 2**n)


def fetch_by_key(
    keys: DataFrame, key: str, fetch: Callable[[list[str]], dict[str, str]], cache: DataFrame | None = None, batch: int = 50, per_second: float = 0.0, retries: int = 2, wait: float = 0.1
) -> DataFrame:
    """(key, body, ``status``): keys fetched in sorted batches, only those without a cached body; answers for other keys are dropped.

    ``per_second`` limits the calls of one task (0: no limit); with one partition per host the limit is the host's. A batch that fails after ``retries`` is tried key
    by key; what still fails is ``failed``. ``status`` is ``cached``, ``fetched``, ``missing`` (no answer for the key) or ``failed``.
    """
    want = keys.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    todo = want.join(cache.select(key), key, "left_anti") if cache is not None else want

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0.0

        def call(part: list[str]) -> dict[str, str]:
            nonlocal last
            if per_second:
                time.sleep(max(0.0, last + 1 / per_second - time.monotonic()))
                last = time.monotonic()
            return fetch(part)

        for pdf in batches:
            ids = sorted(pdf[key])
            for i in range(0, len(ids), batch):
                part, got, failed = ids[i : i + batch], {}, set()
                try:
                    got = patiently(lambda part=part: call(part), retries, wait)
                except Exception:  # noqa: BLE001  (one bad key must not lose the batch)
                    for k in part:
                        try:
                            got |= patiently(lambda k=k: call([k]), retries, wait)
                        except Exception:  # noqa: BLE001
                            failed.add(k)
                yield pd.DataFrame({key: part, "body": [got.get(k) for k in part], "status": ["failed" if k in failed else "fetched" if k in got else "missing" for k in part]})

    fresh = todo.mapInPandas(run, f"{key} string, body string, status string")
    return fresh if cache is None else cache.join(want, key, "left_semi").select(key, "body", F.lit("cached").alias("status")).unionByName(fresh)


def search_pages(spark: SparkSession, queries: list[str], count: Callable[[str], int], page: Callable[[str, int, int], list[str]], size: int = 1000, retries: int = 2) -> DataFrame:
    """(query, id): archive searches counted first, then read page by page, one row of the plan per page, so pages are read in parallel and a lost task reads its page again.

    A page that comes short (ids vanished while reading) gives what it has; ids are distinct per query.
    """
    pages = [(q, start) for q in queries for start in range(0, patiently(lambda q=q: count(q), retries, 0.1), size)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for q, start in zip(pdf["query"], pdf["start"]):
                ids = patiently(lambda q=q, start=start: page(q, int(start), size), retries, 0.1)
                yield pd.DataFrame({"query": q, "id": ids})

    plan = spark.createDataFrame(pages, "query string, start long")
    return plan.repartition(max(1, min(len(pages), 64))).mapInPandas(run, "query string, id string").distinct()


def search_cursor(query: str, page: Callable[[str, str | None], tuple[list[str], str | None]], retries: int = 2) -> Iterator[str]:
    """The ids of a search whose pages name the next one, until there is none or one comes again."""
    cursor, seen = None, set()
    while cursor not in seen:
        seen.add(cursor)
        ids, cursor = patiently(lambda cursor=cursor: page(query, cursor), retries, 0.1)
        yield from ids
        if cursor is None:
            return


def build_slices(taxa: list[str], strategies: list[str], since: str, until: str, dense: set[int] = frozenset()) -> list[dict]:
    """Archive queries, one per taxon, strategy and period, because long answers are cut off.

    Periods are calendar years between the two days (both included), quarters in the ``dense`` years; the first and the last are cut to the days.
    """
    lo, hi = pd.Timestamp(since), pd.Timestamp(until)
    out = []
    for t, s, year in itertools.product(taxa, strategies, range(lo.year, hi.year + 1)):
        for p in pd.period_range(f"{year}-01", f"{year}-12", freq="Q" if year in dense else "Y"):
            a, b = max(lo, p.start_time), min(hi, p.end_time.normalize())
            if a <= b:
                clauses = [f"tax_tree({t})", f'library_strategy="{s}"', f"first_public>={a:%Y-%m-%d}", f"first_public<={b:%Y-%m-%d}"]
                out.append({"slice": f"{t}-{s}-{p}", "query": " AND ".join(clauses)})
    return out


def export_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """The current filtered result, ordered, with a header."""
    sink(df, path, "csv", order)


def digest(text: str) -> str:
    """The cache key of an address."""
    return hashlib.sha256(text.encode()).hexdigest()
