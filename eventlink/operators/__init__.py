"""DataFrame operators.  Import submodules directly: ``from eventlink.operators import events``."""
