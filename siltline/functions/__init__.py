"""Expressions and naming rules. Expressions are Spark SQL text: wide entities repeat them for up to 131 columns,
and one ``selectExpr`` builds such a plan many times faster than as many Column objects."""
