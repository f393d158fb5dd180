"""Writers for archives, status logs, graph exports, evaluation logs, reports and index tables."""
