"""Training-data operators.

Nothing outside this subpackage imports it. Each module holds one operator with
its own interface; ``queries`` binds them to the tables of the driver contract.
"""
