from .messages import alert_frame, flatten, parse_flatten, parse_flatten_counted, parse_messages, to_messages
from .run import observed_counts, read_message_files, run_file_stream, run_until_done, write_stream
from .score import score_clean, score_messages
