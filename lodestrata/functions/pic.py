"""Picture clauses to canonical types, and canonical types to target languages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions.text import as_col, group, strip

CANONICAL = "struct<kind:string,length:int,precision:int,scale:int,signed:boolean,packed:boolean,binary:boolean,raw_pic:string>"
#: Usages that store packed decimals, and binaries.
PACKED, BINARY = ("COMP-3", "COMP_3", "PACKED-DECIMAL", "PACKED_DECIMAL"), ("COMP", "COMP-4", "COMP_4", "BINARY")


def _canonical(kind: Column | str, **fields: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    names = {f.name: f.dataType for f in T.StructType.fromDDL(CANONICAL[7:-1])}
    return F.struct(*((kind if n == "kind" else fields.get(n, F.lit(None))).cast(t).alias(n) for n, t in names.items()))


def normalize_pic(pic: Column | str, usage: Column | str) -> Column:
    """The canonical type of a picture with a usage (null usage: DISPLAY).

    Integer digits are those of the first 9(n), or else all 9s of the whole picture; scale is that of the
    first 9(n) after V, or else the 9s there; precision is their sum, so 999V99 has 7.
    """
    p, u = F.upper(strip(pic)), F.upper(strip(F.coalesce(as_col(usage), F.lit("DISPLAY"))))
    clean = F.regexp_replace(p, "^S+", "")
    count = lambda x: F.length(F.regexp_replace(x, "[^9]", ""))
    digits = lambda x: F.when(group(x, r"9\((\d+)\)") != "", group(x, r"9\((\d+)\)").cast("int")).otherwise(count(x))
    # what follows the first V, up to the next
    after = F.coalesce(F.get(F.split(clean, "V"), F.lit(1)), F.lit(""))
    scale, packed, binary = digits(after), u.isin(*PACKED), u.isin(*BINARY)
    kind = F.when(scale > 0, "decimal").when(binary, "binary").when(packed, "packed_decimal").otherwise("numeric")
    length = group(clean, r"\((\d+)\)")
    return (
        F.when(F.coalesce(as_col(pic), F.lit("")) == "", _canonical("group", length=F.lit(0)))
        .when(p.rlike(r"[Z*$,]") & ~p.contains("9") & ~p.contains("X"), _canonical("edited_numeric", raw_pic=p, signed=p.rlike(r"^[+-]")))
        .when(clean.rlike("^[XA]"), _canonical("alphanumeric", length=F.when(length != "", length.cast("int")).otherwise(1), signed=F.lit(False)))
        .when(clean.contains("9"), _canonical(kind, precision=digits(clean) + scale, scale=scale, signed=p.startswith("S"), packed=packed, binary=binary))
        .otherwise(_canonical("unknown", raw_pic=p))
    )


def java_type(ct: Column) -> Column:
    """(java_type, python_type, constraint, note, import) of a canonical type; import is null where none is needed."""
    n = lambda f: F.coalesce(ct[f], F.lit(0))
    flag = lambda f: F.when(F.coalesce(ct[f], F.lit(False)), "True").otherwise("False")
    by_size = F.when(n("precision") <= 9, "int").otherwise("long")
    decimal = F.format_string("precision=%d scale=%d RoundingMode=HALF_EVEN", n("precision"), n("scale"))
    binary_type = F.when(n("precision") <= 4, "short").otherwise(by_size)
    signed = F.concat(F.format_string("precision=%d signed=", n("precision")), flag("signed"))
    packed = F.when(F.coalesce(ct["packed"], F.lit(False)), " COMP-3").otherwise("")

    def out(java: Column | str, python: str, constraint: Column | str, note: Column | str, needs: str | None = None) -> Column:
        lit = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(lit(java).alias("java_type"), F.lit(python).alias("python_type"), lit(constraint).alias("constraint"), lit(note).alias("note"), F.lit(needs).cast("string").alias("import"))

    money = "java.math.BigDecimal"
    return (
        F.when(ct["kind"] == "alphanumeric", out("String", "str", F.format_string("maxLength=%d", n("length")), F.format_string("PIC X(%d)", n("length"))))
        .when(ct["kind"] == "decimal", out("BigDecimal", "Decimal", decimal, F.concat(F.format_string("PIC S9(%d)V9(%d)", n("precision") - n("scale"), n("scale")), packed), money))
        .when(ct["kind"] == "packed_decimal", out("BigDecimal", "Decimal", F.concat(decimal, F.lit(" packed=true")), "COMP-3 packed decimal — use BigDecimal to preserve rounding semantics", money))
        .when(ct["kind"] == "binary", out(binary_type, "int", signed, "COMP/COMP-4 binary"))
        .when(ct["kind"] == "numeric", out(by_size, "int", signed, "PIC 9 zoned decimal"))
        .when(ct["kind"] == "edited_numeric", out("String", "str", "formatted numeric display", "ZZZ,ZZZ display — format on output"))
        .when(ct["kind"] == "group", out("Object", "dict", "group item — decompose to fields", "01-level group → Java class or record"))
        .otherwise(out("Object", "Any", "", ct["kind"]))
    )


def spark_type(kind: str, precision: int = 0, scale: int = 0) -> T.DataType:
    """The Spark type that holds a canonical type; decimals beyond 38 digits stay text."""
    if kind in ("decimal", "packed_decimal"):
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if kind in ("binary", "numeric"):
        return T.ShortType() if kind == "binary" and precision <= 4 else T.IntegerType() if precision <= 9 else T.LongType() if precision <= 18 else T.StringType()
    return T.StringType()
