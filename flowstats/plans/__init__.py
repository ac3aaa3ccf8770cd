"""Report plans: one DataFrame -> DataFrame function per report."""
