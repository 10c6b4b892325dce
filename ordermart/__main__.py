"""``python -m ordermart run|kpis ...`` -- see ``ordermart.cli``."""

from .cli import main

main()
