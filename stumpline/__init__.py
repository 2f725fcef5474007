"""Sequential-event and user-value analytics as Spark DataFrame operators.

Every public operator is a function from DataFrame(s) to a DataFrame. Nothing
is collected in the data path; the only values that reach the driver are
results whose size is bounded and checked (a list of hot keys, a coefficient
vector, a handful of thresholds).
"""
