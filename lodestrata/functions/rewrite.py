"""Names, predicates and verbs in the target language."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import as_col, strip

#: Replacements in this order, wherever the text stands (AND and OR inside names too).
PREDICATE = (
    ("NOT =", "!="), ("NOT >", "<="), ("NOT <", ">="), (" = ", " == "), (" > ", " > "), (" < ", " < "), (" >= ", " >= "), (" <= ", " <= "),
    ("AND", "&&"), ("OR", "||"), ("NOT ", "!"), ("SPACES", '""'), ("LOW-VALUES", '"\\0"'), ("HIGH-VALUES", '"\\xFF"'), ("ZEROES", "0"), ("ZEROS", "0"),
)
#: Calls for each edge type, file operation and screen verb; {} takes the named parameter.
PERFORM_CALLS = {"PERFORM": "methodCall", "PERFORM_CONDITIONAL": "conditionalMethodCall", "PERFORM_UNTIL": "whileLoop", "PERFORM_VARYING": "forLoop", "PERFORM_THRU": "methodCallRange"}
FILE_CALLS = {
    "READ": "repository.findById(key)", "WRITE": "repository.save(record)", "REWRITE": "repository.save(record)", "DELETE": "repository.deleteById(key)",
    "OPEN": "// OPEN — handled by Spring Data lifecycle", "CLOSE": "// CLOSE — handled by Spring Data lifecycle",
    "START": "repository.findByKeyGreaterThanEqual(key)", "READNEXT": "repository.findNext(cursor)",
}
CICS_CALLS = {
    "RETURN": ("TRANSID", 'return CicsResponse.returnTo("{}", commArea)'), "XCTL": ("PROGRAM", 'cicsXctl("{}", commArea)'), "LINK": ("PROGRAM", 'cicsLink("{}", commArea)'),
    "SEND": ("MAP", 'cicsMap.send("{}", mapData)'), "RECEIVE": ("MAP", 'cicsMap.receive("{}", mapData)'), "READ": ("DATASET", 'vsam.read("{}", key)'),
    "WRITE": ("DATASET", 'vsam.write("{}", record)'), "REWRITE": ("DATASET", 'vsam.rewrite("{}", record)'), "DELETE": ("DATASET", 'vsam.delete("{}", key)'),
    "STARTBR": ("DATASET", 'vsam.startBrowse("{}", key)'), "READNEXT": ("DATASET", 'vsam.readNext("{}", record)'), "ENDBR": ("DATASET", 'vsam.endBrowse("{}", record)'),
}
MQ_CALLS = {
    "MQOPEN": 'jmsTemplate.setDefaultDestinationName("{}")', "MQGET": 'jmsTemplate.receive("{}")', "MQPUT1": 'jmsTemplate.send("{}", message)',
    "MQCLOSE": "// MQCLOSE — handled by JMS connection lifecycle", "GET": 'jmsTemplate.receive("{}")', "PUT": 'jmsTemplate.send("{}", message)',
}


def camel_case(name: Column | str) -> Column:
    """FIRST-SECOND_THIRD as firstSecondThird."""
    parts = F.split(as_col(name), "[-_]")
    return F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, F.lower(x)).otherwise(F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 20))))), "")


def predicate(condition: Column | str) -> Column:
    out = as_col(condition)
    for old, new in PREDICATE:
        out = F.replace(out, F.lit(old), F.lit(new))
    return strip(out)


def _filled(pattern: str, value: Column) -> Column:
    a, found, b = pattern.partition("{}")
    return F.concat(F.lit(a), value, F.lit(b)) if found else F.lit(pattern)


def perform_call(edge_type: Column | str) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in PERFORM_CALLS.items() for x in kv))[as_col(edge_type)], F.lit("methodCall"))


def file_call(operation: Column | str) -> Column:
    op = as_col(operation)
    return F.coalesce(F.create_map(*(F.lit(x) for kv in FILE_CALLS.items() for x in kv))[F.upper(op)], F.concat(F.lit("repository."), F.lower(op), F.lit("()")))


def cics_call(verb: Column | str, params: Column) -> Column:
    """A screen verb with its map of parameters; other verbs name the verb and list the parameters."""
    verb = as_col(verb)
    out = None
    for name, (key, pattern) in CICS_CALLS.items():
        x = _filled(pattern, F.coalesce(params[key], F.lit("")))
        out = F.when(verb == name, x) if out is None else out.when(verb == name, x)
    shown = F.array_join(F.transform(F.map_entries(params), lambda e: F.concat(F.lit("'"), e["key"], F.lit("': '"), e["value"], F.lit("'"))), ", ")
    return out.otherwise(F.concat(F.lit("cics"), F.upper(F.left(verb, F.lit(1))), F.lower(F.substring(verb, 2, 99)), F.lit("({"), shown, F.lit("})")))


def mq_call(operation: Column | str, queue: Column | str) -> Column:
    op, queue = as_col(operation), as_col(queue)
    out = None
    for name, pattern in MQ_CALLS.items():
        out = (F if out is None else out).when(F.upper(op) == name, _filled(pattern, queue))
    return out.otherwise(F.concat(F.lit("jms."), F.lower(op), F.lit('("'), queue, F.lit('")')))


def program_type(name: Column | str) -> Column:
    """online for CO..., batch for CB..., else unknown."""
    two = F.left(F.upper(as_col(name)), F.lit(2))
    return F.when(two == "CO", "online").when(two == "CB", "batch").otherwise("unknown")
