"""The driver's tables seen as links and admin sources, with the queries run on them."""
