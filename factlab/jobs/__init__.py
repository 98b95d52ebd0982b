"""Jobs for ``spark-submit`` or ``python -m``."""
