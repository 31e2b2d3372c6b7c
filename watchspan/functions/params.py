"""Typed access to the parameters of an event, as SQL expression text.

SQL text keeps plan building short: one expression is one call to the JVM, where the same tree built
column by column takes dozens.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How a parameter's fields are read as each wanted type; bool before int before value.
_READERS = {
    "string": "coalesce(cast(p.boolValue as string), p.intValue, p.value)",
    "boolean": "coalesce(p.boolValue, try_cast(p.value as boolean))",
    "bigint": "coalesce(cast(p.boolValue as bigint), try_cast(p.intValue as bigint), try_cast(p.value as bigint))",
    # a scalar becomes a one-element list
    "array<string>": "coalesce(p.multiValue, nullif(array_compact(array(coalesce(cast(p.boolValue as string), p.intValue, p.value))), array()))",
}


def param_sql(name: str, as_type: str = "string", default: str | None = None, params: str = "_event.parameters") -> str:
    """A parameter by name as the wanted type; of repeated names the last one counts."""
    found = f"try_element_at(transform(filter({params}, p -> p.name = '{name}'), p -> {_READERS[as_type]}), -1)"
    return found if default is None else f"coalesce({found}, {default})"


def param(name: str, as_type: str = "string", default: str | None = None, params: str = "_event.parameters") -> Column:
    return F.expr(param_sql(name, as_type, default, params))


def scope_list_sql(params: str) -> str:
    """Array of (scope_name, product_bucket).

    `scope_data` messages win; only when there is no message at all the plain `scope` list counts.
    """
    messages = f"flatten(transform(filter({params}, p -> p.name = 'scope_data' and size(p.multiMessageValue) > 0), p -> p.multiMessageValue))"
    last = "try_element_at(filter(m.parameter, q -> q.name = '{}'), -1)"
    pair = (
        f"named_struct('scope_name', {last.format('scope_name')}.value, "
        f"'product_bucket', get({last.format('product_bucket')}.multiValue, 0))"
    )
    from_messages = f"filter(transform({messages}, m -> {pair}), s -> s.scope_name <> '')"
    names = f"flatten(transform(filter({params}, p -> p.name = 'scope' and size(p.multiValue) > 0), p -> p.multiValue))"
    from_names = (
        f"transform(array_compact({names}), n -> named_struct('scope_name', n, 'product_bucket', cast(null as string)))"
    )
    has_message = f"exists({params}, p -> p.name = 'scope_data' and size(p.multiMessageValue) > 0)"
    return f"case when {has_message} then {from_messages} else {from_names} end"
