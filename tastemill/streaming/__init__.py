"""

The column expressions in ``tastemill.functions`` and the aggregates without
windows over rows work on streaming frames as they are.
"""
