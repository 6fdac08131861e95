"""DataFrame-to-DataFrame operators.

They write no tables. Those built on ``ordered.split_hot`` count group sizes when called.
"""
