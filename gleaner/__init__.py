"""Spark-native retrieval, chat-request, file-intake and web-page preparation."""
