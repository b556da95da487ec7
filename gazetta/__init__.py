"""gazetta: resolve messy postal addresses against an administrative hierarchy, on Spark."""
