"""The table pipelines: Bronze, Silver, Gold, and the flow that chains them."""
