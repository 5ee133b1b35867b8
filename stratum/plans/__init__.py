"""The bronze, silver and gold models and the pipeline that builds them."""
