"""eventlink: column-parameterised Spark DataFrame operators for longitudinal
event data -- cohort building, next-event linkage, code grouping, exclusion and
labelling, contextual attributes in long form, feature profiling and score
evaluation.

Every operator takes and returns DataFrames; column names are parameters.
"""

__version__ = "0.1.0"
