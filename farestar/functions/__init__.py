"""SQL expressions shared by the operators.

Every function takes and returns expression text, to be used in ``selectExpr``, ``where`` or
``F.expr``.  Text composes like the statement it ends up in, needs no session to be defined,
and crosses to the JVM once for each column instead of once for each function call.
"""
