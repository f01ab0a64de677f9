"""reverbkit: audience-reaction analytics (comments vs. what was said) on Spark.

Subpackages: ``functions`` (Column expressions), ``operators`` (DataFrame
operators), ``sources`` (readers / sinks), ``plans`` (the multi-video flow
and the driver queries), ``streaming``. See README.md.
"""

__version__ = "0.1.0"
