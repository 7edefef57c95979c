"""The registered queries: each operator on the given tables, with the SQL that gives the same rows.

``lineitem`` stands for observations (order: asset, part, supplier: view, quantity: weight, discount: score),
``part`` for parts and materials, ``embeddings`` for a bank of vectors, ``events`` for progress. The data are stand-ins;
what a query shows is the operator.
"""
