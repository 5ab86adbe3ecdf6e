"""Job control, screen maps, transaction catalogues, table definitions, hierarchical databases and assembler stubs as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lodestrata.functions.text import group, groups, none_if_empty, strip
from lodestrata.operators.windows import by, carry_forward, first_wins, running
from lodestrata.sources.lines import joined_files, stem

#: Most characters of a DD name.
DD_NAME = 8

def _file() -> WindowSpec:
    return by("source_file", "line_num")


def _logical() -> WindowSpec:
    return by("source_file", "n")


def _glued(lines: DataFrame, starts: Column, text: Column, separator: str) -> DataFrame:
    """(source_file, n, line_num, text): physical lines joined to logical ones, each from a line where `starts`."""
    rows = lines.withColumns({"n": running(starts, _file()), "_t": text})
    parts = F.array_sort(F.collect_list(F.struct("line_num", F.col("_t").alias("text"))))
    return rows.groupBy("source_file", "n").agg(F.min("line_num").alias("line_num"), F.array_join(F.transform(parts, lambda r: r["text"]), separator).alias("text"))


def disposition(text: Column | str) -> Column:
    """The first value of DISP=, upper-cased; UNKNOWN where there is none."""
    pattern = r"(?i)DISP=(?:\(([^)]+)\)|([A-Z]+))"
    first = F.coalesce(none_if_empty(group(text, pattern)), none_if_empty(group(text, pattern, 2)))
    return F.coalesce(F.upper(strip(F.get(F.split(first, ","), F.lit(0)))), F.lit("UNKNOWN"))


def dataset_name(text: Column | str) -> Column:
    return none_if_empty(group(text, r"(?i)DSN=([^\s,]+)"))


def jcl_lines(lines: DataFrame) -> DataFrame:
    """Logical lines of job control: // with blanks goes on with the line before, whatever that is."""
    goes_on = F.col("line").rlike(r"^//\s") & (F.col("line_num") > 1)
    text = F.when(goes_on, strip(F.substring("line", 3, 1 << 20))).otherwise(F.regexp_replace("line", r"\s+$", ""))
    return _glued(lines, ~goes_on, text, " ")


def jcl(lines: DataFrame) -> DataFrame:
    """Datasets of job steps: job_name, step_name, program_name, dd_name, dataset_name, disposition, steplib, parm, line_num, source_file.

    Lines of in-stream data are skipped up to /*; SYS* names and those without a dataset too; STEPLIB belongs to the step.
    """
    name = "[A-Z0-9@#$]{1,8}"
    rows = jcl_lines(lines).where(~F.col("text").startswith("//*"))
    stream = F.col("text").rlike(rf"(?i)^//{name}\s+DD\s+") & F.col("text").rlike(r"(?i)DD\s+\*\s*$")
    rows = rows.withColumn("mark", F.when(F.col("text").startswith("/*"), 0).when(stream, 1))
    # in-stream data: the last mark before a line opens it
    rows = rows.withColumn("data", F.coalesce(carry_forward(F.col("mark"), _logical(), strictly=True), F.lit(0))).where("data = 0 AND (mark IS NULL OR mark = 1)")
    job, step = rf"(?i)^//({name})\s+JOB\s+", rf"(?i)^//({name})\s+EXEC\s+(?:PGM=({name}))?"
    rows = rows.withColumns({
        "job": F.upper(none_if_empty(group("text", job))),
        "step": F.when(F.col("text").rlike(step), F.struct(F.upper(group("text", step)).alias("name"), F.upper(group("text", step, 2)).alias("program"), group("text", r"(?i)PARM=([^\s,]+)").alias("parm"), F.col("n").alias("n"))),
    })
    # one job to a file: the last JOB statement names it, or else the file
    whole = F.last("job", ignorenulls=True).over(_logical().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumns({"job_name": F.coalesce(whole, F.upper(stem("source_file"))), "in_step": carry_forward(F.col("step"), _logical())})
    dd = rf"(?i)^//({name})\s+DD\s+"
    dds = rows.where(F.col("step").isNull() & F.col("job").isNull() & F.col("mark").isNull() & F.col("text").rlike(dd) & F.col("in_step").isNotNull())
    dds = dds.withColumns({"dd_name": F.upper(group("text", dd)), "dataset_name": dataset_name("text")}).where("dataset_name IS NOT NULL")
    in_step = by(["source_file", "in_step.n"], "n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dds = dds.withColumn("steplib", F.coalesce(F.last(F.when(F.col("dd_name") == "STEPLIB", F.col("dataset_name")), ignorenulls=True).over(in_step), F.lit("")))
    kept = dds.where((F.col("dd_name") != "STEPLIB") & ~F.col("dd_name").startswith("SYS"))
    return kept.select(
        "job_name", F.col("in_step.name").alias("step_name"), F.col("in_step.program").alias("program_name"), "dd_name", "dataset_name", disposition("text").alias("disposition"),
        "steplib", F.col("in_step.parm").alias("parm"), "line_num", "source_file",
    )


def gdg_references(jobs: DataFrame) -> DataFrame:
    """Generations of data groups: base_dsn, job_name, dd_name, generation, disposition."""
    pattern = r"^(.+?)\(([+-]?\d+)\)$"
    found = jobs.where(F.col("dataset_name").rlike(pattern))
    return found.select(group("dataset_name", pattern).alias("base_dsn"), "job_name", "dd_name", group("dataset_name", pattern, 2).alias("generation"), "disposition")


def pds_references(jobs: DataFrame) -> DataFrame:
    """Members of load libraries."""
    found = jobs.where(~F.col("dataset_name").rlike(r"^(.+?)\(([+-]?\d+)\)$") & F.col("dataset_name").contains("(") & F.upper("dataset_name").contains("LOADLIB"))
    return found.select("job_name", F.col("dataset_name").alias("dsn"), "dd_name")


def params(text: Column | str) -> Column:
    """KEY=(VALUE) and KEY=VALUE as a map; the last of a key wins."""
    pattern = r"(?i)([A-Z]+)=(?:\(([^)]*)\)|([^\s,]+))"
    return _last_wins(groups(text, pattern, 1), F.zip_with(groups(text, pattern, 2), groups(text, pattern, 3), lambda a, b: F.when(a != "", a).otherwise(b)))


def _last_wins(keys: Column, values: Column) -> Column:
    pairs = F.zip_with(F.transform(keys, F.upper), F.transform(values, strip), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    last = F.aggregate(pairs, F.array().cast("array<struct<key:string,value:string>>"), lambda acc, p: F.concat(F.filter(acc, lambda x: x["key"] != p["key"]), F.array(p)))
    return F.map_from_entries(last)


def bms(lines: DataFrame) -> DataFrame:
    """Fields of screen maps, with their map and mapset; unnamed ones are numbered within a file."""
    w = _file()
    text = F.regexp_replace("line", r"\s+$", "")
    goes_on = F.coalesce(F.lag(text.endswith("-")).over(w), F.lit(False))
    rows = _glued(lines, ~goes_on, F.when(text.endswith("-"), F.concat(F.expr("left(regexp_replace(line, '\\\\s+$', ''), length(regexp_replace(line, '\\\\s+$', '')) - 1)"), F.lit(" "))).otherwise(text), "")
    macro = r"(?i)^([A-Z0-9@#$]{1,8})?\s+(DFHMSD|DFHMDI|DFHMDF)\s+(.*)$"
    rows = rows.where(F.col("text").rlike(macro) & ~F.col("text").startswith("*"))
    rows = rows.select("source_file", "n", "line_num", F.upper(group("text", macro)).alias("name"), F.upper(group("text", macro, 2)).alias("macro"), params(group("text", macro, 3)).alias("p"))
    get = lambda key, default="": F.coalesce(F.try_element_at("p", F.lit(key)), F.lit(default))
    size = F.split(get("SIZE", "24,80"), ",")
    part = lambda a, i, default: F.coalesce(F.get(a, F.lit(i)).try_cast("int"), F.lit(default))
    the_map = F.struct(F.col("name").alias("name"), part(size, 0, 24).alias("rows"), part(size, 1, 80).alias("cols"))
    rows = rows.withColumns({
        "mapset": carry_forward(F.when((F.col("macro") == "DFHMSD") & (F.col("name") != ""), F.col("name")), _logical()),
        "map": carry_forward(F.when(F.col("macro") == "DFHMDI", the_map), _logical()),
    })
    fields = rows.where((F.col("macro") == "DFHMDF") & F.col("map").isNotNull())
    pos = F.split(F.regexp_replace(get("POS", "1,1"), "[()]", ""), ",")
    at = F.transform(pos, lambda x: strip(x).try_cast("int"))
    known = F.get(at, F.lit(0)).isNotNull() & ((F.size(at) < 2) | F.get(at, F.lit(1)).isNotNull())
    filler = running(F.col("name") == "", _logical()) - 1
    attrb, has = F.upper(get("ATTRB")), lambda x: F.upper(get("ATTRB")).contains(x)
    return fields.select(
        "source_file", F.coalesce("mapset", F.upper(stem("source_file"))).alias("mapset"), F.col("map.name").alias("map"), F.col("map.rows").alias("rows"), F.col("map.cols").alias("cols"),
        F.when(F.col("name") != "", F.col("name")).otherwise(F.format_string("FILLER%03d", filler)).alias("name"), (F.col("name") != "").alias("is_named"),
        F.when(known, F.get(at, F.lit(0))).otherwise(0).alias("row"), F.when(~known, 0).when(F.size(at) >= 2, F.get(at, F.lit(1))).otherwise(1).alias("col"),
        F.coalesce(get("LENGTH", "0").try_cast("int"), F.lit(0)).alias("length"), get("ATTRB").alias("attrb"), get("COLOR").alias("color"), get("HILIGHT").alias("hilight"),
        F.left(get("INITIAL"), F.lit(50)).alias("initial"), (attrb.contains("ASKIP") | attrb.contains("PROT")).alias("protected"), has("NUM").alias("numeric"), has("BRT").alias("bright"),
        has("DRK").alias("dark"), has("UNPROT").alias("input"), has("FSET").alias("fset"), has("IC").alias("ic"), "line_num",
    )


def bms_stubs(fields: DataFrame) -> DataFrame:
    """Copybook lines of a map: length, attribute and input of each named field, then the output redefinition."""
    named = fields.where("is_named").withColumn("k", F.row_number().over(by(["source_file", "map"], "line_num")))
    pic = F.format_string("PIC X(%d).", F.greatest("length", F.lit(1)))
    part = lambda k, text: F.struct(F.lit(k).alias("part"), text.alias("text"))
    put = lambda suffix, p: F.concat(F.lit("           02 "), F.col("name"), F.lit(suffix + " "), p)
    first = F.array(part(1, put("L", F.lit("COMP PIC S9(4)."))), part(2, put("A", F.lit("PIC X."))), part(3, put("I", pic)))
    second = F.array(part(4, F.lit("           02 FILLER PIC X(3).")), part(5, put("O", pic)))
    body = named.select("source_file", "map", "k", F.explode(F.array(F.struct(F.lit(1).alias("half"), first.alias("rows")), F.struct(F.lit(3).alias("half"), second.alias("rows")))).alias("h"))
    body = body.select("source_file", "map", F.col("h.half").alias("half"), "k", F.explode("h.rows").alias("r")).select("source_file", "map", "half", "k", F.col("r.part").alias("part"), F.col("r.text").alias("text"))
    maps = named.select("source_file", "map").distinct()
    head = lambda half, text: maps.select("source_file", "map", F.lit(half).alias("half"), F.lit(0).alias("k"), F.lit(0).alias("part"), text.alias("text"))
    name = F.col("map")
    heads = head(0, F.concat(F.lit("       01 "), name, F.lit("I."))).unionByName(head(2, F.concat(F.lit("       01 "), name, F.lit("O REDEFINES "), name, F.lit("I."))))
    lines = heads.unionByName(body)
    return lines.select("source_file", "map", F.row_number().over(by(["source_file", "map"], ["half", "k", "part"])).alias("line_num"), F.col("text").alias("line"))


def csd(lines: DataFrame) -> DataFrame:
    """Resources of a transaction catalogue: kind, name, group, params (a map), ordinal, source_file."""
    kept = lines.withColumn("t", strip("line")).where((F.col("t") != "") & ~F.col("t").startswith("*"))
    text = joined_files(kept, "t", " ")
    define, param = r"(?i)DEFINE\s+(FILE|PROGRAM|TRANSACTION|MAPSET|LIBRARY)\s*\(\s*([^)]+)\s*\)", r"(?i)([A-Z0-9]+)\s*\(\s*([^)]*)\s*\)"
    rows = text.select("source_file", F.posexplode(F.split("text", r"(?i)(?=\bDEFINE\b)")).alias("ordinal", "block")).where(F.col("block").rlike(define))
    p = _last_wins(groups("block", param, 1), groups("block", param, 2))
    out = rows.select("source_file", "ordinal", F.upper(group("block", define)).alias("kind"), F.upper(strip(group("block", define, 2))).alias("name"), p.alias("params"))
    return out.withColumn("group", F.coalesce(F.try_element_at("params", F.lit("GROUP")), F.lit("")))


#: Parameters of each kind with their defaults.
CSD_COLUMNS = {
    "FILE": {"dsname": "DSNAME", "status": "STATUS", "add": "ADD", "read": "READ", "update": "UPDATE", "delete": "DELETE"}, "PROGRAM": {"language": "LANGUAGE", "status": "STATUS"},
    "TRANSACTION": {"program": "PROGRAM", "status": "STATUS", "taskdataloc": "TASKDATALOC"}, "MAPSET": {"status": "STATUS"}, "LIBRARY": {},
}


def csd_kind(resources: DataFrame, kind: str) -> DataFrame:
    """The resources of one kind, with columns of their own."""
    own = [F.coalesce(F.try_element_at("params", F.lit(p)), F.lit("COBOL" if p == "LANGUAGE" else "")).alias(c) for c, p in CSD_COLUMNS[kind].items()]
    return resources.where(F.col("kind") == kind).select("name", "group", *own, "source_file", "ordinal")


def ddl(files: DataFrame) -> DataFrame:
    """Tables of (source_file, text) definitions: table_name, columns, primary_key, references_table, references_columns, ordinal."""
    create = r"(?i)CREATE\s+TABLE\s+([A-Z0-9_.]+)"
    rows = files.select("source_file", F.posexplode(F.split("text", r"(?i)(?=\bCREATE\s+TABLE\b)")).alias("ordinal", "part")).where(F.col("part").rlike(r"(?i)^CREATE\s+TABLE"))
    # the body ends where the depth of parentheses is back at 0: a fold over the pieces that end in )
    tail = F.regexp_replace("part", create, "")
    pieces = F.split(tail, r"(?<=\))")
    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("body"))
    count = lambda x, c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))

    def step(s: Column, x: Column) -> Column:
        depth = s["depth"] + count(x, "(") - count(x, ")")
        return F.when(s["done"], s).otherwise(F.struct(depth.alias("depth"), ((depth == 0) & x.contains(")")).alias("done"), F.concat(s["body"], x).alias("body")))

    rows = rows.withColumn("folded", F.aggregate(pieces, zero, step)).withColumn("body", F.when(F.col("folded.done"), F.col("folded.body")).otherwise(""))
    column = r"(?i)[\s(,]+([A-Z_][A-Z0-9_]{1,29})\s+(CHAR|VARCHAR|INTEGER|SMALLINT|DECIMAL|TIMESTAMP|DATE|TIME)(?:\(([^)]+)\))?(\s+NOT\s+NULL)?"
    cols = F.arrays_zip(*(groups("body", column, k).alias(n) for k, n in ((1, "name"), (2, "type"), (3, "size"), (4, "nn"))))
    cols = F.transform(cols, lambda c: F.struct(F.upper(c["name"]).alias("name"), F.upper(c["type"]).alias("type"), c["size"].alias("size"), (c["nn"] != "").alias("not_null")))
    key, refers = r"(?i)PRIMARY\s+KEY\s*\(([^)]+)\)", r"(?i)REFERENCES\s+([A-Z0-9_.]+)\s*\(([^)]+)\)"
    keys = F.when(group("body", key) != "", F.transform(F.split(group("body", key), ","), strip)).otherwise(F.array().cast("array<string>"))
    return rows.select(
        "source_file", group("part", create).alias("table_name"), cols.alias("columns"), keys.alias("primary_key"), strip(group("body", refers)).alias("references_table"),
        strip(group("body", refers, 2)).alias("references_columns"), "ordinal",
    )


def ddl_indexes(files: DataFrame) -> DataFrame:
    pattern = r"(?i)CREATE\s+(?:UNIQUE\s+)?INDEX\s+([A-Z0-9_.]+)\s+ON\s+([A-Z0-9_.]+)"
    return files.select("source_file", F.explode(F.arrays_zip(groups("text", pattern, 1).alias("index_name"), groups("text", pattern, 2).alias("table_name"))).alias("i")).select("source_file", "i.*")


def dbd(lines: DataFrame) -> DataFrame:
    """Segments, fields and logical children of hierarchical databases: one row each, with its database and segment."""
    t = F.regexp_replace(F.regexp_replace("line", r"\s+$", ""), "C$", "")
    rows = lines.where((strip("line") != "") & ~strip("line").startswith("*")).withColumn("t", t)
    base, segm = r"(?i)DBD\s+NAME=([A-Z0-9@#$]+),ACCESS=\(?([A-Z,]+)\)?", r"(?i)SEGM\s+NAME=([A-Z0-9@#$]+)(?:,PARENT=([A-Z0-9@#]+))?(?:,BYTES=(\d+))?"
    field, child = r"(?i)FIELD\s+NAME=\(?([A-Z0-9@#$,SEQ]+)\)?(?:,START=(\d+))?(?:,BYTES=(\d+))?(?:,TYPE=([A-Z]+))?", r"(?i)LCHILD\s+NAME=\(?([A-Z0-9@#$]+),([A-Z0-9@#$]+)\)?"
    kind = F.when(F.col("t").rlike(base), "DBD").when(F.col("t").rlike(segm), "SEGM").when(F.col("t").rlike(field), "FIELD").when(F.col("t").rlike(child), "LCHILD")
    rows = rows.withColumn("kind", kind).where("kind IS NOT NULL")
    number = lambda p, k: F.coalesce(none_if_empty(group("t", p, k)).cast("int"), F.lit(0))
    raw = F.upper(group("t", field))
    name = F.when(F.col("kind") == "SEGM", F.upper(group("t", segm))).when(F.col("kind") == "FIELD", F.replace(F.replace(raw, F.lit(",SEQ"), F.lit("")), F.lit("SEQ,"), F.lit(""))).when(F.col("kind") == "LCHILD", F.upper(group("t", child)))
    rows = rows.withColumns({
        "name": name,
        "db": carry_forward(F.when(F.col("kind") == "DBD", F.struct(F.upper(group("t", base)).alias("name"), F.upper(group("t", base, 2)).alias("access"))), _file()),
        "segment": carry_forward(F.when(F.col("kind") == "SEGM", F.upper(group("t", segm))), _file()),
    })
    return rows.where((F.col("kind") != "DBD") & ((F.col("kind") != "FIELD") | F.col("segment").isNotNull())).select(
        "source_file", "line_num", F.coalesce("db.name", F.lit("")).alias("db_name"), F.coalesce("db.access", F.lit("")).alias("access"), "kind", "segment", "name",
        F.when(F.col("kind") == "SEGM", F.coalesce(none_if_empty(F.upper(group("t", segm, 2))), F.lit("ROOT"))).alias("parent"),
        F.when(F.col("kind") == "SEGM", number(segm, 3)).when(F.col("kind") == "FIELD", number(field, 3)).alias("bytes"),
        F.when(F.col("kind") == "FIELD", number(field, 2)).alias("start"),
        F.when(F.col("kind") == "FIELD", F.coalesce(none_if_empty(F.upper(group("t", field, 4))), F.lit("CHAR"))).alias("type"),
        F.when(F.col("kind") == "FIELD", raw.contains("SEQ")).alias("seq"), F.when(F.col("kind") == "LCHILD", F.upper(group("t", child, 2))).alias("child_db"),
    )


def dbd_segments(rows: DataFrame) -> DataFrame:
    """Segments with their field count and key: the last field that is marked as the sequence."""
    segments = rows.where("kind = 'SEGM'").select("source_file", "db_name", "access", F.col("name").alias("segment"), "parent", "bytes")
    fields = rows.where("kind = 'FIELD'").groupBy("source_file", "segment").agg(F.count("*").alias("n_fields"), F.max_by("name", F.when(F.col("seq"), F.col("line_num"))).alias("key_field"))
    return segments.join(fields, ["source_file", "segment"], "left").select(segments["*"], F.coalesce("n_fields", F.lit(0)).alias("n_fields"), F.coalesce("key_field", F.lit("")).alias("key_field"))


def assembler_stubs(lines: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """The first entry point of each file: name, source_file, entry_type, description."""
    pattern = r"(?i)^([A-Z0-9@#$]{1,8})\s+(CSECT|START|ENTRY)\b"
    first = first_wins(lines.where(F.col("line").rlike(pattern)), ["source_file"], ["line_num"])
    name, out = F.upper(group("line", pattern)), F.lit("Assembler routine")
    for key, text in (descriptions or {}).items():
        out = F.when(name == key, text).otherwise(out)
    return first.select(name.alias("name"), "source_file", F.upper(group("line", pattern, 2)).alias("entry_type"), out.alias("description"))


def vsam_type(dsn: Column | str) -> Column:
    d = F.upper(dsn)
    return F.when(d.contains("AIX") | d.contains("PATH"), "AIX").when(d.contains("ESDS"), "ESDS").when(d.contains("RRDS"), "RRDS").otherwise("KSDS")


def vsam_schemas(files: DataFrame, lines: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Files of the catalogue with what the programs' file descriptions say of them.

    Record length, key and copybook are the last found, in order of file and line; `overrides` has (name,
    record_length, key_field, record_copybook) that take precedence.
    """
    base = first_wins(files, ["name"], [F.desc("source_file"), F.desc("ordinal")])
    base = base.select("name", F.col("dsname").alias("dsn"), "status", "read", "add", "update", "delete", vsam_type("dsname").alias("vsam_type"))
    text = strip("line")
    select = r"(?i)SELECT\s+([A-Z0-9-]+)\s+ASSIGN\s+TO\s+([A-Z0-9-]+)"
    assigned = joined_files(lines).select("source_file", F.posexplode(F.arrays_zip(groups("text", select, 1).alias("fd"), groups("text", select, 2).alias("file"))).alias("place", "s"))
    assigned = assigned.groupBy("source_file", F.upper("s.fd").alias("fd")).agg(F.upper(F.max_by("s.file", "place")).alias("file"))
    # a description goes from its FD line to the first line that begins a record
    fd = F.when(text.rlike(r"(?i)^FD\s+[A-Z0-9-]+"), F.upper(group(text, r"(?i)^FD\s+([A-Z0-9-]+)")))
    rows = lines.withColumns({"fd": carry_forward(fd, _file()), "is_fd": fd.isNotNull(), "record": text.startswith("01 ")})
    rows = rows.withColumn("group_n", running(F.col("is_fd"), _file()))
    ended = F.coalesce(F.max(F.col("record").cast("int")).over(by(["source_file", "group_n"], "line_num").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = rows.withColumn("ended", ended).where("fd IS NOT NULL AND NOT is_fd AND ended = 0")
    named = inside.join(assigned, ["source_file", "fd"], "left").withColumn("name", F.coalesce("file", "fd"))
    last = lambda x: F.max_by(x, F.when(x.isNotNull(), F.struct("source_file", "line_num")))
    record = none_if_empty(group("line", r"(?i)RECORD(?:\s+CONTAINS)?\s+(\d+)\s+(?:TO\s+(\d+)\s+)?(?:CHARACTERS|BYTES)?")).cast("int")
    key, copy = none_if_empty(F.upper(group("line", r"(?i)(?:RECORD\s+KEY|KEY\s+IS)\s+([A-Z0-9-]+)"))), none_if_empty(F.upper(group("line", r"(?i)COPY\s+([A-Z0-9]+)")))
    facts = named.groupBy("name").agg(last(record).alias("record_length"), last(key).alias("key_field"), last(copy).alias("record_copybook"), F.array_sort(F.collect_set(F.upper(stem("source_file")))).alias("programs_using"))
    out = base.join(facts, "name", "left")
    if overrides is not None:
        names = ("record_length", "key_field", "record_copybook")
        out = out.join(overrides.select("name", *(F.col(c).alias(f"_{c}") for c in names)), "name", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in names}).drop(*(f"_{c}" for c in names))
    # an alternate index belongs to the first file that has its dataset without the suffix
    aix = base.where("vsam_type = 'AIX'").select(F.replace(F.replace("dsn", F.lit(".AIX.PATH"), F.lit("")), F.lit(".AIX"), F.lit("")).alias("base_dsn"), F.col("name").alias("aix"))
    owners = aix.join(base.select(F.col("dsn").alias("base_dsn"), "name"), "base_dsn").groupBy("aix").agg(F.min("name").alias("name"))
    indexes = owners.groupBy("name").agg(F.array_sort(F.collect_list("aix")).alias("alternate_indexes"))
    empty = F.array().cast("array<string>")
    return out.join(indexes, "name", "left").withColumns({
        "record_length": F.coalesce("record_length", F.lit(0)), "record_copybook": F.coalesce("record_copybook", F.lit("")),
        "programs_using": F.coalesce("programs_using", empty), "alternate_indexes": F.coalesce("alternate_indexes", empty),
    })


def vsam_from_jobs(schemas: DataFrame, jobs: DataFrame, lines: DataFrame) -> DataFrame:
    """(name, dd_name, program): files, the DD that a job gives their dataset, and programs that assign a name which holds that of the DD.

    A DD name has 1 to 8 characters, so the names assigned are taken apart into pieces of that length and meet it by equality.
    """
    select = r"(?i)SELECT\s+([A-Z0-9-]+)\s+ASSIGN\s+(?:TO\s+)?([A-Z0-9-]+)"
    assigned = joined_files(lines).select(F.upper(stem("source_file")).alias("program"), F.explode(groups("text", select, 2)).alias("assign")).select("program", F.upper("assign").alias("assign")).distinct()
    dds = jobs.where(~F.col("dd_name").startswith("SYS")).groupBy(F.col("dataset_name").alias("dsn")).agg(F.max_by("dd_name", F.struct("source_file", "line_num")).alias("dd_name"))
    start, size = F.sequence(F.lit(1), F.greatest(F.length("assign"), F.lit(1))), F.sequence(F.lit(1), F.lit(DD_NAME))
    pieces = F.array_distinct(F.flatten(F.transform(start, lambda at: F.transform(size, lambda n: F.substring(F.col("assign"), at, n)))))
    parts = assigned.select("program", F.explode(pieces).alias("dd_name")).distinct()
    return schemas.join(dds, "dsn").join(parts, "dd_name").select("name", "dd_name", "program").distinct()


