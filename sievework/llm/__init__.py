"""Training-data operators: ten corpus operators, their queries and their oracles.

Nothing outside this subpackage imports it.
"""
