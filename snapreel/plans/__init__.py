"""The models (staging, intermediate, marts), the registered queries and their oracles."""
